"""Feature pipeline as a ``pyspark.ml.Pipeline``.

numeric → mean imputation → population standard scaling; categorical →
most-frequent imputation → one-hot with the alphabetically first category
dropped; ids → lexicographic string codes with an unseen bucket.  All stages
are MLlib estimators except the population scaler (MLlib's scaler divides by
the sample std), which is a small custom Estimator over one aggregate.

``save_features`` / ``load_features`` keep a fitted pipeline in a folder: MLlib
stages in their own format, the numbers of the custom stages as rows, and the
id code tables, which grow with the data, as Parquet tables."""

from __future__ import annotations

import json
import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class PopulationStandardScaler(Estimator, HasInputCols, HasOutputCols):
    """(x − mean) / population std per column; std 0 → 1."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PopulationStandardScalerModel":
        cols = self.getInputCols()
        r = dataset.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        stats = [(r[f"m{i}"] or 0.0, r[f"s{i}"] or 1.0) for i in range(len(cols))]
        return PopulationStandardScalerModel(cols, self.getOutputCols(), stats)


class PopulationStandardScalerModel(Model):
    def __init__(self, cols, outs, stats):
        super().__init__()
        self.cols, self.outs, self.stats = cols, outs, stats

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({o: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                                    for c, o, (m, s) in zip(self.cols, self.outs, self.stats)})


class MostFrequentImputer(Estimator, HasInputCols, HasOutputCols):
    """Categorical nulls → most frequent value (ties → smallest)."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "MostFrequentImputerModel":
        from kiln.operators.aggs import group_mode
        cols = self.getInputCols()
        # all columns in one aggregate: stack (column, value), mode per column
        long = dataset.select(F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("string").alias("_v"))
                                                  for c in cols])).alias("_s")).select("_s._c", "_s._v")
        found = {r["_c"]: r["m"] for r in group_mode(long, ["_c"], "_v", "m").collect()}  # one row per column
        return MostFrequentImputerModel(cols, self.getOutputCols(), [found.get(c, "Unknown") for c in cols])


class MostFrequentImputerModel(Model):
    def __init__(self, cols, outs, modes):
        super().__init__()
        self.cols, self.outs, self.modes = cols, outs, modes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in dataset.schema.fields}
        return dataset.withColumns({o: F.coalesce(F.col(c), F.lit(m).cast(types[c]))
                                    for c, o, m in zip(self.cols, self.outs, self.modes)})


def feature_pipeline(numeric: list[str], categorical: list[str], ids: list[str],
                     features: str = "features", unknown: str = "error") -> Pipeline:
    stages = []
    num_d = [f"{c}__d" for c in numeric]
    num_imp = [f"{c}__i" for c in numeric]
    num_s = [f"{c}__s" for c in numeric]
    if numeric:
        stages.append(_CastDouble(numeric, num_d))
        stages += [Imputer(inputCols=num_d, outputCols=num_imp, strategy="mean"),
                   PopulationStandardScaler(inputCols=num_imp, outputCols=num_s)]
    cat_i = [f"{c}__m" for c in categorical]
    cat_x = [f"{c}__x" for c in categorical]
    cat_v = [f"{c}__oh" for c in categorical]
    if categorical:
        stages.append(MostFrequentImputer(inputCols=categorical, outputCols=cat_i))
        # alphabetDesc + dropLast drops the alphabetically first category.
        stages.append(StringIndexer(inputCols=cat_i, outputCols=cat_x, stringOrderType="alphabetDesc",
                                    handleInvalid=unknown))
        stages.append(OneHotEncoder(inputCols=cat_x, outputCols=cat_v, dropLast=True, handleInvalid=unknown))
    id_x = [f"{c}__code" for c in ids]
    if ids:
        # Lexicographic string codes, unseen id → number of classes.  The code
        # table grows with the data, so it is a joined DataFrame (never a
        # driver-side label array as in StringIndexer), and codes stay numeric.
        stages.append(DistributedIdEncoder(ids, id_x))
    stages.append(VectorAssembler(inputCols=num_s + cat_v + id_x, outputCol=features, handleInvalid="keep"))
    return _IdsFirst(stages=stages)


class _IdsFirst(Pipeline):
    """Fitted in the given order, so that no fit reads through the id joins; the fitted
    pipeline encodes ids first, so that the joins do not carry the others' vectors."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        fitted = super()._fit(dataset).stages
        return PipelineModel(sorted(fitted, key=lambda s: not isinstance(s, DistributedIdEncoderModel)))


class DistributedIdEncoder(Estimator):
    def __init__(self, cols, outs):
        super().__init__()
        self.cols, self.outs = cols, outs

    def _fit(self, dataset: DataFrame) -> "DistributedIdEncoderModel":
        from kiln.operators.features import IdEncoder
        return DistributedIdEncoderModel(IdEncoder(list(self.cols)).fit(dataset), self.cols, self.outs)


class DistributedIdEncoderModel(Model):
    def __init__(self, encoder, cols, outs):
        super().__init__()
        self.encoder, self.cols, self.outs = encoder, cols, outs

    def _transform(self, dataset: DataFrame) -> DataFrame:
        tmp = [f"__keep_{c}" for c in self.cols]
        d = dataset.withColumns({t: F.col(c) for t, c in zip(tmp, self.cols)})
        d = self.encoder.transform(d)
        d = d.withColumns({o: F.col(c).cast("double") for c, o in zip(self.cols, self.outs)})
        return d.withColumns({c: F.col(t) for t, c in zip(tmp, self.cols)}).drop(*tmp)


class _CastDouble(Model):
    def __init__(self, cols, outs):
        super().__init__()
        self.cols, self.outs = cols, outs

    def _transform(self, dataset):
        return dataset.withColumns({o: F.col(c).cast("double") for c, o in zip(self.cols, self.outs)})


def save_features(model: PipelineModel, spark: SparkSession, path: str) -> str:
    """Write a fitted ``feature_pipeline`` under ``path``."""
    rows = []
    for i, stage in enumerate(model.stages):
        where = os.path.join(path, f"stage-{i:02d}")
        if isinstance(stage, DistributedIdEncoderModel):
            for c in stage.cols:
                stage.encoder.tables[c].write.mode("overwrite").parquet(os.path.join(where, c))
            sizes = {c: stage.encoder.sizes[c].first()[0] for c in stage.cols}
            rows.append((i, "ids", json.dumps([stage.cols, stage.outs, sizes])))
        elif isinstance(stage, PopulationStandardScalerModel):
            rows.append((i, "scale", json.dumps([stage.cols, stage.outs, stage.stats])))
        elif isinstance(stage, MostFrequentImputerModel):
            rows.append((i, "impute", json.dumps([stage.cols, stage.outs, stage.modes])))
        elif isinstance(stage, _CastDouble):
            rows.append((i, "double", json.dumps([stage.cols, stage.outs])))
        else:
            PipelineModel([stage]).write().overwrite().save(where)
            rows.append((i, "mllib", "[]"))
    spark.createDataFrame(rows, "stage INT, kind STRING, state STRING").coalesce(1).write.mode("overwrite") \
        .parquet(os.path.join(path, "stages"))
    return path


def load_features(spark: SparkSession, path: str) -> PipelineModel:
    """The pipeline that ``save_features`` wrote."""
    from kiln.operators.features import IdEncoder
    stages = []
    for r in spark.read.parquet(os.path.join(path, "stages")).orderBy("stage").collect():
        where, state = os.path.join(path, f"stage-{r['stage']:02d}"), json.loads(r["state"])
        if r["kind"] == "ids":
            cols, outs, sizes = state
            tables = {c: spark.read.parquet(os.path.join(where, c)) for c in cols}
            counts = {c: spark.range(1).select(F.lit(sizes[c]).cast("long").alias("n")) for c in cols}
            stages.append(DistributedIdEncoderModel(IdEncoder(cols, tables, counts), cols, outs))
        elif r["kind"] == "mllib":
            stages += PipelineModel.load(where).stages
        else:
            stages.append({"scale": PopulationStandardScalerModel, "impute": MostFrequentImputerModel,
                           "double": _CastDouble}[r["kind"]](*state))
    return PipelineModel(stages)
