"""Rule search (N9): conjunctions of quantile intervals and category values that
cover rows of a target with high precision.

The rows are coded once (the interval number of each numeric column, the value of each
category) and counted per combination of codes.  A level of the search is one aggregate
over these counts: for every rule of the beam and every value of a further column, the
covered rows and hits.  From this contingency table the driver takes the counts of
*all* intervals of a column as differences of running sums, so a level tests every
extension of every beam rule by one job.  The table that comes to the driver is bounded:
beam x columns x bins for intervals, and beam x columns / ``min_coverage`` for
categories, as only values that cover enough rows are sent."""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.plans.ordering import exact_quantiles_multi
from kiln.session import cut_lineage

RULES = "rank INT, rule STRING, n_terms INT, coverage DOUBLE, precision DOUBLE, n_covered LONG"


@dataclass(frozen=True)
class Term:
    """One condition: codes ``low`` to ``high`` of a numeric column (value in
    (above, upto], either end None), or a category's ``value``."""

    place: int
    column: str
    low: int = 0
    high: int = 0
    above: float | None = None
    upto: float | None = None
    value: str | None = None

    def __str__(self) -> str:
        if self.value is not None:
            return f"{self.column} = '{self.value}'"
        ends = [f"{self.column} > {self.above!r}"] * (self.above is not None) + [f"{self.column} <= {self.upto!r}"] * (self.upto is not None)
        return " AND ".join(ends)

    def holds(self) -> Column:
        """The condition on the rows' own columns."""
        x = F.col(self.column)
        if self.value is not None:
            return x.cast("string") == self.value
        parts = [x.cast("double") > self.above] * (self.above is not None) + [x.cast("double") <= self.upto] * (self.upto is not None)
        return reduce(lambda a, b: a & b, parts)

    def coded(self) -> Column:
        """The condition on the coded columns."""
        x = F.col(f"c{self.place}")
        return x == self.value if self.value is not None else x.cast("int").between(self.low, self.high)


def rule_column(rule: tuple[Term, ...]) -> Column:
    """A rule as one condition, for ``explain.rule_stats`` or a filter."""
    return reduce(lambda a, b: a & b, [t.holds() for t in rule])


def _extensions(rule, found: dict, cuts: dict, columns: list[str], least: float):
    """(rule with one more term, covered, hits) of every extension of a beam rule."""
    held = {t.place for t in rule}
    for place, column in enumerate(columns):
        counts = found.get(place)
        if place in held or not counts:
            continue
        if column not in cuts:
            new = [(Term(place, column, value=v), n, h) for v, (n, h) in counts.items()]
        else:
            ends, new = cuts[column], []
            for low in range(len(ends) + 1):
                n = h = 0
                for high in range(low, len(ends) + 1):
                    more = counts.get(str(high), (0, 0))
                    n, h = n + more[0], h + more[1]
                    if low or high < len(ends):
                        new.append((Term(place, column, low, high, ends[low - 1] if low else None,
                                         ends[high] if high < len(ends) else None), n, h))
        for term, n, h in new:
            if n and n >= least:
                yield tuple(sorted((*rule, term), key=lambda t: t.place)), n, h


def search_rules(df: DataFrame, target: Column, numeric: list[str], categorical: list[str], bins: int = 10,
                 max_terms: int = 3, beam: int = 20, min_coverage: float = 0.01):
    """[(rule, covered, hits)] of all rules the search kept, best first: highest
    precision, then most rows, fewest terms, text; and the number of rows.  With a
    beam that holds every rule of the shorter levels the search is exhaustive.

    Quantile cuts are rounded to 6 places.  A null matches no condition, a null target
    is no hit; repeated rows count as often as they stand; a column of one value has
    the one interval that all its rows lie in; an empty table has no rules."""
    columns = [*numeric, *categorical]
    cuts: dict[str, list[float]] = {c: [] for c in numeric}
    if numeric:
        names = [f"q{i}" for i in range(1, bins)]
        for r in exact_quantiles_multi(df, numeric, [i / bins for i in range(1, bins)], names).collect():  # one row a column
            cuts[r["column_name"]] = sorted({round(r[n], 6) for n in names if r[n] is not None})
    codes = []
    for i, c in enumerate(columns):
        if c in cuts:
            x = F.col(c).cast("double")
            at = sum((F.when(x > cut, 1).otherwise(0) for cut in cuts[c]), F.lit(0))
            codes.append(F.when(x.isNotNull(), at).cast("string").alias(f"c{i}"))
        else:
            codes.append(F.col(c).cast("string").alias(f"c{i}"))
    coded = df.select(*codes, F.coalesce(target.cast("int"), F.lit(0)).alias("_hit"))
    cells = cut_lineage(coded.groupBy(*[f"c{i}" for i in range(len(columns))])
                        .agg(F.count(F.lit(1)).alias("n"), F.sum("_hit").cast("long").alias("h")))
    total = cells.agg(F.sum("n")).first()[0] or 0
    least = min_coverage * total
    is_interval = F.array(*[F.lit(c in cuts) for c in columns])

    def order(x):
        rule, n, h = x
        return -Fraction(h, n), -n, len(rule), " AND ".join(map(str, rule))

    kept: dict = {}
    level = [((), total, 0)]
    for _ in range(max_terms if total else 0):
        rules = [rule for rule, _, _ in level]
        met = F.array(*[F.when(reduce(lambda a, b: a & b, [t.coded() for t in rule], F.lit(True)), F.lit(i)) for i, rule in enumerate(rules)])
        values = F.posexplode(F.array(*[F.col(f"c{i}") for i in range(len(columns))])).alias("place", "v")
        table = (cells.select("*", F.explode(F.filter(met, lambda m: m.isNotNull())).alias("rule")).select("rule", "n", "h", values)
                 .filter("v IS NOT NULL").groupBy("rule", "place", "v").agg(F.sum("n").alias("n"), F.sum("h").alias("h"))
                 .filter((F.col("n") >= least) | F.get(is_interval, F.col("place"))))
        found: dict = {}
        for r in table.collect():  # bounded, see above
            found.setdefault(r["rule"], {}).setdefault(r["place"], {})[r["v"]] = (r["n"], r["h"])
        new = {}
        for i, rule in enumerate(rules):
            for longer, n, h in _extensions(rule, found.get(i, {}), cuts, columns, least):
                new[longer] = (longer, n, h)
        level = sorted(new.values(), key=order)[:beam]
        kept.update({rule: x for x in level for rule in [x[0]]})
        if not level:
            break
    return sorted(kept.values(), key=order), total


def rule_search(df: DataFrame, target: Column, numeric: list[str], categorical: list[str], top: int = 20, **options) -> DataFrame:
    """The ``top`` best rules as a table (rank, rule, n_terms, coverage, precision,
    n_covered); ``options`` as in ``search_rules``."""
    found, total = search_rules(df, target, numeric, categorical, **options)
    rows = [(i + 1, " AND ".join(map(str, rule)), len(rule), n / total, h / n, n) for i, (rule, n, h) in enumerate(found[:top])]
    return df.sparkSession.createDataFrame(rows, RULES)
