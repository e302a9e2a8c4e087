"""Quality classifier: a sparse rule ensemble.

Shallow random-forest trees are grown on text statistics of labelled
documents; every root-to-node path is a conjunctive rule; an L1-penalised
logistic regression on the rules' 0/1 indicators leaves few of them with a
weight; the remaining rules are compiled into one Spark column expression, so
scoring runs inside the scan of the texts.

Only the fit is bounded: about ``MAX_TRAIN`` labelled rows, picked by a hash of
their id.  Scores cover every row and whole texts.

Rules: a null text is the empty text, whose statistics are all 0; several
labels of one document are averaged (0.5 counts as 1); labels without a text
and texts without a label are not learnt from; with no rows, or one class
only, to learn from, every score is that class's share (0.5 without rows);
repeated rows are scored alike; other columns pass through."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import materialize

MAX_TRAIN, TREES, DEPTH, L1, SEED, ACCEPT = 20_000, 24, 3, 0.002, 11, 0.7
SPACE = r"[\x20\x09-\x0D]"


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def statistics(text: Column) -> dict[str, Column]:
    """Numbers of a whole text; neither label, language, source nor id enters."""
    t = F.coalesce(text, F.lit(""))
    chars, words = F.length(t), F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]++"))

    def per(x, of):
        return F.coalesce(x / F.nullif(of, F.lit(0)), F.lit(0.0))

    return {
        "log_words": F.log1p(words),
        "word_length": per(chars, words),
        "upper": per(chars - F.length(F.regexp_replace(t, r"\p{Lu}++", "")), chars),
        "symbols": per(_count(t, "#%&*$@^~<>{}[]\\=_+"), chars),
        "pipes": per(_count(t, "|"), words),
        "bangs": per(_count(t, "!?"), words),
        "stops": per(_count(t, ".,;:"), words),
        "digits": per(_count(t, "0123456789"), chars),
        "lines": per(_count(t, "\n"), words),
        # words that the next one repeats
        "repeats": per(F.regexp_count(t, F.lit(rf"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++){SPACE}++(?=\1(?![^\x20\x09-\x0D]))")), words),
    }


def paths(tree_text: str) -> set[tuple]:
    """Every root-to-node path of a printed decision tree, as a sorted tuple of
    (feature, is_greater, threshold), the tightest bound per feature and side."""
    out, stack = set(), []
    for line in tree_text.splitlines():
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, (int(m[2]), m[3] == ">", float(m[4]))))
        tight: dict = {}
        for _, (f, greater, x) in stack:
            old = tight.get((f, greater))
            tight[f, greater] = x if old is None else max(old, x) if greater else min(old, x)
        out.add(tuple(sorted((f, g, x) for (f, g), x in tight.items())))
    return out


def rule(conditions: tuple, names: list[str]) -> Column:
    """A rule as a column condition."""
    out = F.lit(True)
    for f, greater, x in conditions:
        out = out & ((F.col(names[f]) > x) if greater else (F.col(names[f]) <= x))
    return out


def fit(train: DataFrame, names: list[str], label: str = "label", trees: int = TREES, depth: int = DEPTH,
        l1: float = L1, seed: int = SEED) -> tuple[float, list[tuple[float, tuple]]]:
    """(intercept, [(weight, conditions)]) of the ensemble; ``train`` holds the
    statistics and a 0/1 label."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector
    n, good = train.agg(F.count(F.lit(1)), F.sum(label)).first()
    if not n or good in (0, n):
        return (0.0 if not n else 30.0 if good else -30.0), []
    table = VectorAssembler(inputCols=names, outputCol="stats").transform(train).select(F.col(label).cast("double").alias("y"), "stats", *names)
    forest = RandomForestClassifier(labelCol="y", featuresCol="stats", numTrees=trees, maxDepth=depth, maxBins=64,
                                    seed=seed, featureSubsetStrategy="sqrt").fit(table)
    rules = sorted(set().union(*(paths(t.toDebugString) for t in forest.trees)))
    if not rules:
        return 0.0, []
    fired = table.select("y", array_to_vector(F.array(*[rule(r, names).cast("double") for r in rules])).alias("fired"))
    model = LogisticRegression(labelCol="y", featuresCol="fired", elasticNetParam=1.0, regParam=l1, maxIter=60).fit(fired)
    return float(model.intercept), [(float(w), r) for w, r in zip(model.coefficients.toArray(), rules) if w]


def compiled(model: tuple[float, list[tuple[float, tuple]]], names: list[str]) -> Column:
    """The ensemble as one expression: the probability of label 1."""
    intercept, rules = model
    total = F.lit(intercept)
    for weight, conditions in rules:
        total = total + F.when(rule(conditions, names), F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_train: int) -> DataFrame:
    """Statistics and label of about ``max_train`` labelled documents, picked by
    a hash of the id; so many ids at most are broadcast."""
    known = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(key).alias("_id")).agg((F.avg(label) >= 0.5).cast("double").alias("label")))
    total = max(1, known.count())
    picked = known.filter(F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, max_train / total)))
    met = docs.select(F.col(key).alias("_id"), F.col(text).alias("_t")).join(F.broadcast(picked), "_id")
    return met.select("label", *[c.cast("double").alias(n) for n, c in statistics(F.col("_t")).items()])


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          max_train: int = MAX_TRAIN, out: str = "score") -> DataFrame:
    """``docs`` plus ``out``, the probability of label 1, learnt from ``labels``."""
    stats = {n: c.cast("double") for n, c in statistics(F.col(text)).items()}
    train = materialize(training_rows(docs, labels, key, text, label, max_train), "quality-train")
    model = fit(train, list(stats), "label")
    keep = [c for c in docs.columns if c != out]
    inner = docs.select(F.struct(*keep).alias("_row"), *[c.alias(n) for n, c in stats.items()])
    return inner.select("_row.*", compiled(model, list(stats)).alias(out))
