"""The registered queries of the training-data operators: ``opN_<name>``."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import UPPER, read, ship

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        @wraps(fn)
        def run(spark, sf_dir):
            ship(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def bpe_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def bpe_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


@register("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.bpe import encode
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, bpe_file(), bpe_pattern(), keep=["doc_id"], ids="ids_sha256", decoded="decoded_sha256", digests=True)


@register("op4_ring_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.sharding import assign
    placed = assign(read(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "home_shard", "hops")


@register("op5_budget_mix")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.mixing import mix, taken
    out = taken(mix(read(spark, sf_dir, "documents")))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


#: The listed rules of the URL query (fixed values): verdict, host, path.
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/"))

OP8_SQL = """
WITH u AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r AS (SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM u)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r"""


@register("op8_url_filter", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.url_filter import judge
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(str(r) for r in URL_RULES) + " AS t(verdict, host, path)")
    return judge(read(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@register("op7_minhash_neardup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.neardup import link
    return link(read(spark, sf_dir, "documents").select("doc_id", "text"))


OP1_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""


@register("op1_maxscore_topk", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.maxscore import top_k
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op2_rule_ensemble")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.common import crc_bucket
    from kiln.llm.quality import ACCEPT, score
    labels = read(spark, sf_dir, "labels").filter(crc_bucket(F.col("doc_id"), 4) != 2)
    scored = score(read(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return scored.select("doc_id", (crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


@register("op6_iblt_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.sketch import fingerprints
    return fingerprints(read(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op10_disclosure")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.pii import KINDS, detect, listed
    found = detect(read(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] < 4)

    def count(i):
        return F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")

    counts = [count(i) for i in range(len(KINDS))]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@register("op9_hmm_score")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.common import crc_bucket
    from kiln.llm.hmm import score
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, crc_bucket(F.col("doc_id"), 5) != 1)


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@register("op11_token_counts")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.token_counts import token_counts
    return token_counts(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file(), keep=["doc_id"])


def audit_filters() -> dict:
    """The filters A to D of the audit query: failure conditions over whole texts."""
    from kiln.llm.common import SPACE
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {"A": n < 100, "B": distinct * 100 < n * 80, "C": capitals * 100 > F.length(text) * 10, "D": text.rlike("[#$%&*|]")}


OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CAST(len(words) < 100 AS INTEGER) + CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INTEGER) * 2
    + CAST(100 * (length(w.t) - length(regexp_replace(w.t, '[A-Z]', '', 'g'))) > 10 * length(w.t) AS INTEGER) * 4
    + CAST(regexp_matches(w.t, '[#$%&*|]') AS INTEGER) * 8 + CAST(coalesce(w.doc_id > first_id, false) AS INTEGER) * 16 AS m
    FROM w JOIN firsts ON w.t = firsts.t LEFT JOIN marks ON w.doc_id = marks.doc_id),
c AS (SELECT part, m, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM f GROUP BY part, m),
l AS (SELECT unnest([0, 1, 2, 3, 4]) AS i),
p AS (SELECT a.i AS a, b.i AS b, c.i AS c, d.i AS d, e.i AS e FROM l a JOIN l b ON b.i <> a.i JOIN l c ON c.i NOT IN (a.i, b.i)
    JOIN l d ON d.i NOT IN (a.i, b.i, c.i) JOIN l e ON e.i NOT IN (a.i, b.i, c.i, d.i)),
s AS (SELECT chr(65 + a) || chr(65 + b) || chr(65 + c) || chr(65 + d) || chr(65 + e) AS filter_order, step,
    CASE step WHEN 1 THEN a WHEN 2 THEN b WHEN 3 THEN c WHEN 4 THEN d ELSE e END AS i,
    CASE WHEN step > 1 THEN 1 << a ELSE 0 END + CASE WHEN step > 2 THEN 1 << b ELSE 0 END + CASE WHEN step > 3 THEN 1 << c ELSE 0 END
    + CASE WHEN step > 4 THEN 1 << d ELSE 0 END AS before FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, i,
    coalesce(sum(n) FILTER ((m & before) = 0 AND ((m >> i) & 1) = 0), 0) AS kept,
    coalesce(sum(n) FILTER ((m & before) = 0 AND ((m >> i) & 1) = 1), 0) AS removed,
    coalesce(sum(n) FILTER ((m & before) <> 0 AND ((m >> i) & 1) = 1), 0) AS redundant,
    coalesce(sum(n) FILTER (m = (1 << i)), 0) AS unique_fails,
    coalesce(sum(g) FILTER ((m & before) = 0 AND ((m >> i) & 1) = 1), 0) AS good_lost,
    coalesce(sum(x) FILTER ((m & before) = 0 AND ((m >> i) & 1) = 1), 0) AS toxic_lost FROM c, s GROUP BY part, filter_order, step, i)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
    CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, i) AS BIGINT) AS shapley FROM r"""


@register("op12_filter_audit", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.filter_audit import audit
    labels = read(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    return audit(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"), audit_filters(), "E", labels, ["good", "toxic"])


def planted_words(key, words):
    """The word-run query's edit (its contract): a tenth of the documents, by the
    crc32 of their id as text, become periodic from some word on."""
    n = F.size(words)
    h = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    a = F.pmod(g, n).cast("int")
    p = (F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1).cast("int")
    tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, a + F.pmod(i - a, p)))
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), F.concat(F.slice(words, 1, a), tail)).otherwise(words)


@register("op13_word_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kiln.llm.common import SPACE
    from kiln.llm.periodic import longest, periodic_runs
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("words", F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACE), ""))
    docs = docs.select("doc_id", F.array_join(planted_words(F.col("doc_id"), F.col("words")), " ").alias("text"))
    found = periodic_runs(docs, keep=["doc_id"]).withColumn("best", longest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
