"""Models (K1–K13) on MLlib, plus the data preparation they share.

Every model is fitted by a distributed MLlib estimator; predictions stay
DataFrames and are scored by the operators in ``metrics``."""

from __future__ import annotations

from pyspark import StorageLevel

import time

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators import metrics
from kiln.operators.pipeline import feature_pipeline

SEED = 42

CLASSIFIERS = {
    "logistic_regression": lambda: LogisticRegression(maxIter=50, family="multinomial"),
    "linear_svc": lambda: OneVsRest(classifier=LinearSVC(maxIter=30)),
    "decision_tree": lambda: DecisionTreeClassifier(maxDepth=8, seed=SEED),
    "random_forest": lambda: RandomForestClassifier(numTrees=100, maxDepth=8, seed=SEED),
    "gradient_boosting": lambda: OneVsRest(classifier=GBTClassifier(maxIter=20, maxDepth=4, seed=SEED)),
}


def prepare(df: DataFrame, numeric, categorical, ids, label: str, split_col: str = "split",
            fit_split: str = "train", keep: bool = True):
    """Fit the I15 pipeline and the label indexer on the training rows only and
    transform every row; returns (prepared rows, fitted pipeline, label classes).
    ``keep``: persist the training rows; not needed for a table that was written."""
    train = df.filter(F.col(split_col) == fit_split)
    if keep:  # several fit passes read it
        train = train.persist(StorageLevel.DISK_ONLY)
    pipe = feature_pipeline(numeric, categorical, ids).fit(train)
    lab = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc",
                        handleInvalid="keep").fit(train)
    out = lab.transform(pipe.transform(df)).select(*df.columns, "features", "label")
    return out, pipe, lab.labels


def fit_classifier(name: str, train: DataFrame, weight_col: str | None = None):
    est = CLASSIFIERS[name]()
    if weight_col and hasattr(est, "setWeightCol"):
        est = est.setWeightCol(weight_col)
    return est.fit(train)


def evaluate(model, data: DataFrame, split_col: str = "split") -> DataFrame:
    """Accuracy and macro / weighted F1 per split: the rows are scored once."""
    m = metrics.classification_summary(model.transform(data), "label", "prediction", by=[split_col])
    return m.select(F.col(split_col).alias("split"), "accuracy", "macro_f1", "weighted_f1")


def leaderboard(data: DataFrame, names, eval_split: str = "val", split_col: str = "split") -> DataFrame:
    """Fit each classifier on train, score on ``eval_split`` and train; one
    row per model with fit seconds and the train − eval gap, best first."""
    spark = data.sparkSession
    rows = []
    train = data.filter(F.col(split_col) == "train")
    for name in names:
        t0 = time.perf_counter()
        model = fit_classifier(name, train)
        fit_s = time.perf_counter() - t0
        pred = model.transform(data.filter(F.col(split_col).isin("train", eval_split)))
        m = (pred.groupBy(split_col).agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("acc"))
             .collect())
        acc = {r[split_col]: r["acc"] for r in m}
        f1 = metrics.classification_summary(pred.filter(F.col(split_col) == eval_split), "label",
                                            "prediction").first()["macro_f1"]
        rows.append((name, float(acc.get(eval_split, 0.0)), float(f1 or 0.0),
                     float(acc.get("train", 0.0) - acc.get(eval_split, 0.0)), fit_s))
    return spark.createDataFrame(rows, "model STRING, accuracy DOUBLE, macro_f1 DOUBLE, gap DOUBLE, fit_seconds DOUBLE") \
        .orderBy(F.col("macro_f1").desc())


def gbt_regressor(train: DataFrame, label: str):
    """K7."""
    return GBTRegressor(labelCol=label, maxIter=30, maxDepth=5, seed=SEED).fit(train)


def linear_regression(train: DataFrame, label: str, features: str = "features", reg: float = 0.0,
                      elastic: float = 0.0, intercept: bool = True):
    """Least squares (normal equations for a few hundred columns)."""
    return LinearRegression(labelCol=label, featuresCol=features, regParam=reg, elasticNetParam=elastic,
                            fitIntercept=intercept, solver="normal" if elastic == 0 else "auto").fit(train)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def als(train: DataFrame, rank: int, nonnegative: bool, user: str = "user", item: str = "item",
        rating: str = "rating", reg: float = 0.05, max_iter: int = 15):
    """Alternating least squares; unknown users / items give NaN
    (``coldStartStrategy='nan'``) and are filled by the caller."""
    return ALS(rank=rank, maxIter=max_iter, regParam=reg, nonnegative=nonnegative, userCol=user, itemCol=item,
               ratingCol=rating, coldStartStrategy="nan", seed=SEED).fit(train)
