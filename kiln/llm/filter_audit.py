"""How filters of a cleaning chain interact, from sorted posting lists.

Every row fails some set of the filters.  The rows are dealt into ranges of
(part, id) and sorted; each range keeps, per filter, the sorted list of failing
entries, and the like for the marks of interest.  Unions over sets of filters and
what a filter adds to them are galloping merges: the shorter list is looked up in
the longer one.  Sizes add up over the ranges, and every order of the filters is
read from them: what a filter removes at a step depends on the set before it only.

Rules: a null part is the empty string; rows of equal id, part and failing set are
one entry with a weight, so a repeated id does not burden a task; null ids are
rows like others (they have no marks, and no smaller id); a part none of whose
rows fails gives zeros; an empty table gives no rows."""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.common import materialize, small_table


def without(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Entries of sorted ``a`` that are not in sorted ``b``; the shorter list gallops through the longer one."""
    if not len(a) or not len(b):
        return a
    if len(a) <= len(b):
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        return a[b[at] != a]
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    stay = np.ones(len(a), bool)
    stay[at[a[at] == b]] = False
    return a[stay]


def within(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Entries common to both sorted lists."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return a[b[at] == a]


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge of two sorted lists, each entry once."""
    if len(a) < len(b):
        a, b = b, a
    new = without(b, a)
    return np.insert(a, np.searchsorted(a, new), new)


def range_sizes(failing: np.ndarray, marks: np.ndarray, weight: np.ndarray, filters: int, n_marks: int) -> np.ndarray:
    """Sizes of one id range: [set before, filter, (rows the filter adds, rows
    failing the set or it, marked rows it adds ...)]; filters of the set itself stay 0."""
    lists = [np.flatnonzero(failing >> f & 1) for f in range(filters)]
    marked = [np.flatnonzero(marks >> m & 1) for m in range(n_marks)]
    out = np.zeros((1 << filters, filters, 2 + n_marks), np.int64)
    unions = [np.empty(0, np.int64)]
    for s in range(1, 1 << filters):
        top = s.bit_length() - 1
        unions.append(union(unions[s ^ 1 << top], lists[top]))
    for s, before in enumerate(unions):
        covered = weight[before].sum()
        for f in range(filters):
            if s >> f & 1:
                continue
            added = without(lists[f], before)
            size = weight[added].sum()
            out[s, f, :2] = size, covered + size
            for m, rows in enumerate(marked):
                out[s, f, 2 + m] = weight[within(added, rows)].sum()
    return out


def posting_sizes(entries: DataFrame, filters: int, n_marks: int) -> DataFrame:
    """Entries (part, id, failing, marks, weight) to rows (part, before, filter,
    added, covered, marked: array), one per range and set; sums make up the table's sizes."""
    schema = T.StructType([T.StructField("part", T.StringType()), T.StructField("before", T.IntegerType()), T.StructField("filter", T.IntegerType()),
                           T.StructField("added", T.LongType()), T.StructField("covered", T.LongType()),
                           T.StructField("marked", T.ArrayType(T.LongType()))])

    def run(batches):
        import pyarrow as pa
        where = [(s, f) for s in range(1 << filters) for f in range(filters) if not s >> f & 1]

        def rows(part, sizes):
            s, f = (np.array(x, np.int32) for x in zip(*where))
            picked = sizes[s, f]
            return pa.RecordBatch.from_arrays([pa.array([part] * len(where), pa.string()), pa.array(s), pa.array(f), pa.array(picked[:, 0]),
                                               pa.array(picked[:, 1]), pa.array(picked[:, 2:].tolist(), pa.list_(pa.int64()))], names=schema.names)

        part, total = None, None
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False)
            failing, marks, weight = (batch.column(i).to_numpy() for i in (1, 2, 3))
            borders = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for a, b in zip(borders, borders[1:]):
                if a == b:
                    continue
                if names[a] != part:
                    if part is not None:
                        yield rows(part, total)
                    part, total = names[a], 0
                total = total + range_sizes(failing[a:b], marks[a:b], weight[a:b], filters, n_marks)
        if part is not None:
            yield rows(part, total)

    return (entries.repartitionByRange("part", "id").sortWithinPartitions("part", "id")
            .select("part", "failing", "marks", "weight").mapInArrow(run, schema))


def audit(df: DataFrame, filters: dict[str, Column], duplicate: str | None = None, marks: DataFrame | None = None,
          mark_names: list[str] | None = None, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step
    (from 1), kept, removed, redundant, unique_fails, <mark>_lost for every mark,
    shapley.

    ``filters``: name to failure condition over the columns of ``df`` (null: not
    failing).  ``duplicate``: name of one more filter, failed by rows whose text
    equals that of any row of smaller id.  ``marks``: id and boolean columns
    ``mark_names``; an id of several rows is marked if any of them is."""
    names = [*filters, *([duplicate] if duplicate else [])]
    mark_names = mark_names or []
    k = len(names)
    if not 0 < k <= 8:
        raise ValueError("one to eight filters")

    def bits(columns):
        return sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(columns)), F.lit(0)).cast("int")

    body = F.coalesce(df[text], F.lit(""))
    rows = df.select(F.coalesce(df[part].cast("string"), F.lit("")).alias("part"), df[id].alias("id"),
                     F.unhex(F.sha2(body, 256)).alias("digest"), bits(filters.values()).alias("failing"))
    rows = materialize(rows.groupBy("part", "id", "digest", "failing").agg(F.count(F.lit(1)).alias("weight")), "audit-rows")
    if duplicate:
        # a row passes when it holds its text's smallest id: a join on (id, text), which no group of copies makes hot
        first = rows.groupBy("digest").agg(F.min("id").alias("id")).filter("id IS NOT NULL").withColumn("_first", F.lit(True))
        rows = rows.join(first, ["id", "digest"], "left")
        rows = rows.withColumn("failing", F.col("failing") + F.when(F.col("id").isNotNull() & F.col("_first").isNull(), 1 << k - 1).otherwise(0))
    if marks is not None:
        own = marks.groupBy(F.col(id).alias("id")).agg(*[F.max(F.col(m)).alias(f"_mark{i}") for i, m in enumerate(mark_names)])
        rows = rows.join(own, "id", "left").withColumn("marks", bits([F.col(f"_mark{i}") for i in range(len(mark_names))]))
    else:
        rows = rows.withColumn("marks", F.lit(0))
    entries = materialize(rows.groupBy("part", "id", "failing", "marks").agg(F.sum("weight").alias("weight")), "audit-entries")

    sizes = posting_sizes(entries.filter("failing <> 0"), k, len(mark_names))
    sums = [F.sum("added").alias("added"), F.sum("covered").alias("covered"),
            *[F.sum(F.col("marked")[i]).alias(f"m{i}") for i in range(len(mark_names))]]
    value = F.struct("added", "covered", *[f"m{i}" for i in range(len(mark_names))])
    table = (sizes.groupBy("part", "before", "filter").agg(*sums)
             .groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct((F.col("before") * k + F.col("filter")).alias("key"), value))).alias("sizes")))
    parts = entries.groupBy("part").agg(F.sum("weight").alias("total")).join(table, "part", "left")

    whole = (1 << k) - 1
    steps = [{"filter_order": "".join(names[i] for i in order), "step": at + 1, "f": f,
              "before": sum(1 << i for i in order[:at]), "others": whole - (1 << f)}
             for order in permutations(range(k)) for at, f in enumerate(order)]
    plan = small_table(df.sparkSession, steps, "filter_order: string, step: int, f: int, before: int, others: int")
    plan = plan.agg(F.collect_list(F.struct(*plan.columns)).alias("plan"))

    def size(before, f, field):
        return F.coalesce(F.element_at("sizes", before * k + f)[field], F.lit(0).cast("long"))

    def shapley(f):
        others = [i for i in range(k) if i != f]
        return sum((size(F.lit(sum(1 << i for i in s)), f, "added") * (factorial(n) * factorial(k - 1 - n))
                    for n in range(k) for s in combinations(others, n)), F.lit(0).cast("long"))

    out = parts.withColumn("_shapley", F.array(*[shapley(f) for f in range(k)])).withColumn("_step", F.explode(plan.scalar()))
    out = out.select("*", "_step.*")
    before, f = F.col("before"), F.col("f")
    removed = size(before, f, "added")
    return out.select("part", "filter_order", "step", (F.col("total") - size(before, f, "covered")).alias("kept"), removed.alias("removed"),
                      (size(F.lit(0), f, "added") - removed).alias("redundant"), size(F.col("others"), f, "added").alias("unique_fails"),
                      *[size(before, f, f"m{i}").alias(f"{m}_lost") for i, m in enumerate(mark_names)], F.get("_shapley", f).alias("shapley"))
