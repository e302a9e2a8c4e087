"""Fit-on-train / apply-anywhere feature operators.

``fit`` runs a few aggregate jobs and keeps state whose size is the number of
columns or categories (driver-side scalars); the id encoder, whose state grows
with the data, keeps it as a DataFrame that ``transform`` joins.  ``transform``
is a lazy projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.mathx import clip, fourier_terms
from kiln.operators.aggs import group_mode
from kiln.plans.ordering import exact_quantiles, exact_quantiles_multi, global_row_number, rank_within_group


def _one_row(df: DataFrame) -> dict:
    return df.first().asDict()


@dataclass
class IQRClipper:
    """Per column [Q1 − λ·IQR, Q3 + λ·IQR]; values outside are clipped (not
    deleted), nulls stay null."""
    cols: list[str]
    lam: float = 1.5
    bounds: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "IQRClipper":
        for r in exact_quantiles_multi(df, self.cols, [0.25, 0.75], names=["q1", "q3"]).collect():
            iqr = r["q3"] - r["q1"]
            self.bounds[r["column_name"]] = (r["q1"] - self.lam * iqr, r["q3"] + self.lam * iqr)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in self.bounds.items()})


@dataclass
class SimpleImputer:
    """Fill nulls with the train mean, exact median or most frequent value."""
    cols: list[str]
    strategy: str = "mean"
    values: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "SimpleImputer":
        if self.strategy == "mean":
            self.values = _one_row(df.agg(*[F.avg(c).alias(c) for c in self.cols]))
        elif self.strategy == "median":
            for c in self.cols:
                self.values[c] = _one_row(exact_quantiles(df, c, [0.5], names=["m"]))["m"]
        elif self.strategy == "most_frequent":
            for c in self.cols:
                self.values[c] = _one_row(group_mode(df, None, c, "m"))["m"]
        else:
            raise ValueError(self.strategy)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.values.items()})


@dataclass
class GroupModeImputer:
    """I4: categorical nulls → mode of the column within the row's group, else
    the global mode, else 'Unknown'.  The group column itself is not imputed.
    Group modes are a small table (one row per group value) joined back."""
    cols: list[str]
    group_col: str
    fallback: str = "Unknown"
    group_modes: DataFrame | None = None
    global_modes: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "GroupModeImputer":
        frames = [group_mode(df, [self.group_col], c, f"_gm_{c}") for c in self.cols]
        gm = frames[0]
        for f in frames[1:]:
            gm = gm.join(f, self.group_col, "full")
        self.group_modes = gm
        for c in self.cols:
            row = group_mode(df, None, c, "m").first()
            self.global_modes[c] = row["m"] if row else None
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        j = df.join(self.group_modes, self.group_col, "left")
        j = j.withColumns({c: F.coalesce(F.col(c), F.col(f"_gm_{c}"), F.lit(self.global_modes[c]),
                                         F.lit(self.fallback)) for c in self.cols})
        return j.drop(*[f"_gm_{c}" for c in self.cols])


@dataclass
class MinMaxScaler:
    """(x − min)/(max − min); 0 when the column is constant."""
    cols: list[str]
    stats: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "MinMaxScaler":
        r = _one_row(df.agg(*[F.min(c).alias(f"{c}__lo") for c in self.cols],
                            *[F.max(c).alias(f"{c}__hi") for c in self.cols]))
        self.stats = {c: (r[f"{c}__lo"], r[f"{c}__hi"]) for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (lo, hi) in self.stats.items():
            out[c] = (F.lit(0.0) * F.col(c) if hi == lo
                      else (F.col(c).cast("double") - F.lit(float(lo))) / F.lit(float(hi - lo)))
        return df.withColumns(out)


@dataclass
class StandardScaler:
    """(x − mean)/population std; std 0 → divide by 1 (sklearn rule)."""
    cols: list[str]
    stats: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "StandardScaler":
        r = _one_row(df.agg(*[F.avg(c).alias(f"{c}__m") for c in self.cols],
                            *[F.stddev_pop(c).alias(f"{c}__s") for c in self.cols]))
        self.stats = {c: (r[f"{c}__m"], r[f"{c}__s"] or 1.0) for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in self.stats.items()})


@dataclass
class OneHotDropFirst:
    """I8: one int column per category except the alphabetically first;
    an unseen category raises (``handle_unknown='error'``) or gives all zeros
    (``'ignore'``).  The category list is the fitted state: a column of more than
    ``max_categories`` values raises instead of coming to the driver (such a column
    is an id: see ``IdEncoder``)."""
    cols: list[str]
    handle_unknown: str = "error"
    categories: dict = field(default_factory=dict)
    max_categories: int = 1_000

    def fit(self, df: DataFrame) -> "OneHotDropFirst":
        for c in self.cols:
            found = df.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(c).limit(self.max_categories + 1)
            vals = [r[0] for r in found.collect()]
            if len(vals) > self.max_categories:
                raise ValueError(f"column {c} has more than {self.max_categories} categories")
            self.categories[c] = vals
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, vals in self.categories.items():
            if self.handle_unknown == "error":
                known = F.col(c).isNull() | F.col(c).isin(vals)
                out = out.withColumn(c, F.when(known, F.col(c)).otherwise(
                    F.raise_error(F.concat(F.lit(f"unknown category in {c}: "), F.col(c).cast("string")))))
            out = out.withColumns({f"{c}_{v}": (F.col(c) == F.lit(v)).cast("int") for v in vals[1:]}).drop(c)
        return out


@dataclass
class RareCategoryGrouper:
    """Categories whose share is below ``min_frequency`` become one
    ``infrequent`` category."""
    col: str
    min_frequency: float
    label: str = "infrequent_sklearn"
    keep: list = field(default_factory=list)

    def fit(self, df: DataFrame) -> "RareCategoryGrouper":
        total = df.select(F.count(F.lit(1))).scalar()
        counts = df.filter(F.col(self.col).isNotNull()).groupBy(self.col).agg(F.count(F.lit(1)).alias("_n"))
        self.keep = [r[0] for r in counts.filter(F.col("_n") / total >= self.min_frequency).select(self.col).collect()]
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        c = F.col(self.col)
        return df.withColumn(self.col, F.when(c.isNull() | c.isin(self.keep), c).otherwise(F.lit(self.label)))


@dataclass
class IdEncoder:
    """Ids compared as strings, codes in lexicographic order, unseen → the
    number of classes.  The code table grows with the data, so it stays a
    DataFrame (numbered by the distributed ``global_row_number``) and is joined."""
    cols: list[str]
    tables: dict = field(default_factory=dict)
    sizes: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "IdEncoder":
        # every id column in ONE distributed sort: stack (column, key), rank per column
        stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("string").alias("_key"))
                                                for c in self.cols])).alias("_s")).select("_s._col", "_s._key")
        ids = stacked.filter(F.col("_key").isNotNull()).distinct()
        coded = rank_within_group(ids, ["_col"], ["_key"], out="_code", size_col="_size")
        for c in self.cols:
            mine = coded.filter(F.col("_col") == c)
            self.tables[c] = mine.select("_key", F.col("_code").alias(f"_code_{c}"))
            self.sizes[c] = mine.select(F.coalesce(F.max("_size"), F.lit(0).cast("long")))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.cols:
            t = self.tables[c]
            out = (out.withColumn("_key", F.col(c).cast("string")).join(t, "_key", "left")
                   .withColumn(c, F.coalesce(F.col(f"_code_{c}"), self.sizes[c].scalar())).drop("_key", f"_code_{c}"))
        return out


def fourier_block(df: DataFrame, t: str, blocks: list[tuple[str, float, int]]) -> DataFrame:
    """Fourier terms for several (name, period, order) blocks."""
    return df.select("*", *[c for name, p, n in blocks for c in fourier_terms(F.col(t), p, n, name)])


def lag_block_train_mean(df: DataFrame, key: str, order: str, col: str, lags, train_filter) -> DataFrame:
    """I16: lags of ``col`` inside its series, the missing leading values filled
    by the mean of ``col`` over the series' train rows only."""
    from kiln.operators.windows import lag_features
    means = df.filter(train_filter).groupBy(F.col(key).alias("_key")).agg(F.avg(col).alias("_mean"))
    out = lag_features(df, key, order, [col], lags)
    names = [f"{col}_lag{L}" for L in lags]
    return (out.join(means, F.col(key).eqNullSafe(F.col("_key")), "left")
            .withColumns({n: F.coalesce(F.col(n), F.col("_mean")) for n in names}).drop("_key", "_mean"))


def pacf_lags(df: DataFrame, key: str, order: str, col: str, max_lag: int = 7) -> DataFrame:
    """(key, lag, pacf, selected, bound): Yule–Walker partial
    autocorrelations per series and the lags with |pacf| > 1.96/√n (lag 1 when
    there is none).

    The autocovariances of all series come from one grouped aggregate over lag
    columns; the Durbin–Levinson recursion is a chain of column expressions on
    one row per series.  A constant series has no autocorrelation (null)."""
    from kiln.operators.windows import lag_features
    means = df.groupBy(F.col(key).alias("_key")).agg(F.avg(col).alias("_mean"))
    centred = (df.join(means, F.col(key).eqNullSafe(F.col("_key")))
               .select(key, order, (F.col(col) - F.col("_mean")).alias("_x")))
    lagged = lag_features(centred, key, order, ["_x"], range(1, max_lag + 1))
    g = lagged.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.col("_x") * (F.col(f"_x_lag{k}") if k else F.col("_x"))).alias(f"g{k}") for k in range(max_lag + 1)])
    g = g.select(key, "n", *[(F.col(f"g{k}") / F.nullif(F.col("g0"), F.lit(0.0))).alias(f"r{k}") for k in range(1, max_lag + 1)])
    for k in range(1, max_lag + 1):  # p{k}_{j}: coefficient j of the order-k model
        num, den = F.col(f"r{k}"), F.lit(1.0)
        for j in range(1, k):
            num = num - F.col(f"p{k - 1}_{j}") * F.col(f"r{k - j}")
            den = den - F.col(f"p{k - 1}_{j}") * F.col(f"r{j}")
        g = g.withColumn(f"p{k}_{k}", num / F.nullif(den, F.lit(0.0)))
        g = g.withColumns({f"p{k}_{j}": F.col(f"p{k - 1}_{j}") - F.col(f"p{k}_{k}") * F.col(f"p{k - 1}_{k - j}") for j in range(1, k)})
    bound = F.lit(1.96) / F.sqrt("n")
    lags = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"p{k}_{k}").alias("pacf")) for k in range(1, max_lag + 1)])
    some = F.exists(lags, lambda x: F.abs(x["pacf"]) > bound)
    rows = g.select(key, bound.alias("bound"), F.coalesce(some, F.lit(False)).alias("_some"), F.explode(lags).alias("_l"))
    chosen = F.when(F.col("_some"), F.coalesce(F.abs("_l.pacf") > F.col("bound"), F.lit(False))).otherwise(F.col("_l.lag") == 1)
    return rows.select(key, "_l.lag", "_l.pacf", chosen.alias("selected"), "bound")


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weight n / (k · n_class) per row (``weightCol`` for MLlib)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    total = df.select(F.count(F.lit(1))).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    return df.join(counts, label).withColumn(out, total / (k * F.col("_nc"))).drop("_nc")


def oversample(df: DataFrame, label: str) -> DataFrame:
    """Each minority row repeated floor(n_major / n_class) times
    (``explode`` of a sequence; no join with a generated table)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    major = counts.select(F.max("_nc")).scalar()
    j = df.join(counts, label)
    return j.withColumn("_rep", F.explode(F.sequence(F.lit(1), F.floor(major / F.col("_nc")).cast("int")))) \
        .drop("_nc", "_rep")
