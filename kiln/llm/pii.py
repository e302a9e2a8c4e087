"""Personal data: format spans, and the terms around them that give them away.

Base spans are the leftmost non-overlapping matches of one pattern per kind
(e-mail address, IP address, card number, phone number) that pass the kind's
test.  Their values are the protected entities.  Information-theoretic
sanitisation then estimates from co-occurrence over the whole corpus how much
a term near an entity reveals of it: with document counts n,

    PMI(e, t) = log(n(e, t) n / (n(e) n(t))),   IC(e) = log(n / n(e)),

PMI / IC is 1 when the entity always stands where the term is, and 0 when the
two are independent.  Terms of a ratio of ``GENERALISE`` or more, seen with
the entity in ``SUPPORT`` or more different texts, become ``term`` spans in
the neighbourhood of that entity; those of ``REMOVE`` or more are cut out,
the others replaced by a placeholder.

Only DataFrame functions are used.  Positions are code points, found by
splitting a text at its matches and adding up the lengths of the parts.  The
patterns are written so that a long run without a match costs its length
once (no start inside a run, possessive quantifiers), with the same matches.

Rules: a null text is the empty text; repeated rows are found each on its own
and count as documents, but equal texts are one context of support; an entity
in all documents has no information and reveals nothing; an empty table gives
an empty result; other columns pass through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import materialize
from kiln.llm.url_filter import MAX_BLOCKS, _block, _mask, bloom_filter

KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = r"[A-Za-z0-9._%+-]"
#: The kinds' patterns; equal in matches to the plain ones
#: ``L+@D+(\.D+)+``, ``[0-9]+(\.[0-9]+){3}``, ``[0-9]([\x20-]?[0-9])+`` (of 13 digits or more), ``\+[0-9][\x20().0-9-]+[0-9]``.
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}{4,}+"
REACH, SUPPORT, GENERALISE, REMOVE = 60, 3, 0.8, 0.999


def located(text: Column, pattern: str, base=0) -> Column:
    """array<struct<start, end, value>> of a pattern's matches in a text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    start = F.struct((base if isinstance(base, Column) else F.lit(base)).cast("long").alias("at"),
                     F.array().cast("array<struct<start:bigint,end:bigint,value:string>>").alias("out"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            begin.alias("start"), end.alias("end"), x["value"].alias("value")))).alias("out"))

    return F.aggregate(F.arrays_zip(gaps.alias("gap"), found.alias("value")), start, step, lambda acc: acc["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    back = F.reverse(_digits(value))

    def digit(i):
        d = F.substr(back, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), lambda acc, i: acc + digit(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _gate(kind: str, text: Column) -> Column:
    return F.instr(text, "@") > 0 if kind == "email" else text.rlike(PATTERNS[kind])


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end, value>> of all base kinds, by kind (its
    place in KINDS), then start; texts without a match skip the work."""
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,value:string>>")

    def of(i: int, kind: str) -> Column:
        good = F.filter(located(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
        spans = F.transform(good, lambda m: F.struct(F.lit(i).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
                                                     m["value"].alias("value")))
        return F.when(_gate(kind, text), spans).otherwise(none)

    return F.concat(*[of(i, kind) for i, kind in enumerate(KINDS[:4])])


def _around(text: Column, span: Column) -> Column:
    """The terms within REACH code points of a span, as located structs; words
    that the reach cuts are left out."""
    left = F.greatest(F.lit(0).cast("long"), span["start"] - REACH)
    before = F.substr(text, (left + 1).cast("int"), (span["start"] - left).cast("int"))
    after = F.substr(text, (span["end"] + 1).cast("int"), F.lit(REACH))
    one = F.filter(located(before, TERM, left), lambda m: (left == 0) | (m["start"] > left))
    two = F.filter(located(after, TERM, span["end"]), lambda m: (m["end"] < span["end"] + REACH) | (F.length(after) < REACH))
    return F.concat(one, two)


def _entity(span: Column) -> Column:
    return F.concat(span["kind"].cast("string"), F.lit(":"), F.lower(span["value"]))


def detect(docs: DataFrame, text: str = "text", keep: list[str] | None = None, support: int = SUPPORT,
           generalise: float = GENERALISE, out: str = "spans") -> DataFrame:
    """``keep`` columns plus ``out``: array<struct<kind, start, end, value,
    ratio>>, base spans first (ratio null), then terms (kind 4)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != out]
    body = docs.select(F.struct(*keep).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    base = body.withColumn("_spans", base_spans(F.col("_t")))
    free = F.filter(F.flatten(F.transform("_spans", lambda s: F.transform(_around(F.col("_t"), s), lambda m: F.struct(
        _entity(s).alias("entity"), F.lower(m["value"]).alias("term"), m["start"].alias("start"), m["end"].alias("end"))))),
        lambda m: ~F.exists("_spans", lambda s: (s["start"] < m["end"]) & (s["end"] > m["start"])))
    found = materialize(base.select(
        "_row", "_spans", F.when(F.size("_spans") > 0, free).alias("_near"),
        F.when(F.size("_spans") > 0, F.xxhash64("_t")).alias("_h"), F.monotonically_increasing_id().alias("_rid")), "pii-base")
    flagged = disclosing(found, docs, text, support, generalise)
    near = found.filter("_near IS NOT NULL").select("_rid", F.explode("_near").alias("_m")).select("_rid", "_m.*")
    terms = (near.join(flagged, ["entity", "term"]).groupBy("_rid", "start", "end").agg(F.max("ratio").alias("ratio"), F.first("term").alias("term"))
             .groupBy("_rid").agg(F.array_sort(F.collect_list(F.struct(
                 F.lit(4).alias("kind"), "start", "end", F.col("term").alias("value"), "ratio"))).alias("_terms")))
    based = F.transform("_spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                                     s["value"].alias("value"), F.lit(None).cast("double").alias("ratio")))
    return (found.join(terms, "_rid", "left")
            .select("_row.*", F.concat(based, F.coalesce("_terms", F.slice(based, 1, 0))).alias(out)))


def disclosing(found: DataFrame, docs: DataFrame, text: str, support: int, generalise: float) -> DataFrame:
    """(entity, term, ratio) of the terms that give an entity away.

    Terms are counted over every document, but a Bloom filter of the candidate
    terms keeps all other words out of the shuffle."""
    spans = found.filter("_near IS NOT NULL")
    held = spans.select("_rid", F.explode(F.array_distinct(F.transform("_spans", _entity))).alias("entity"))
    n_entity = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    met = spans.select("_rid", "_h", F.explode(F.array_distinct(F.transform("_near", lambda m: F.struct(
        m["entity"].alias("entity"), m["term"].alias("term"))))).alias("_m"))
    pairs = (met.select("_h", "_m.entity", "_m.term").groupBy("entity", "term", "_h").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.count(F.lit(1)).alias("texts"))
             .filter(F.col("texts") >= support))
    pairs = materialize(pairs, "pii-pairs")
    terms = pairs.select("term").distinct()
    blocks = max(1, min(MAX_BLOCKS, terms.count() * 16 // 64 + 1))
    bloom = bloom_filter(terms.select(F.xxhash64("term").alias("_k")), "_k", blocks)
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TERM), F.lit(0)))).alias("term"))
    k = F.xxhash64("term")
    word, mask = F.element_at(bloom, (_block(k, blocks) + 1).cast("int")), _mask(k)
    n_term = words.filter(word.bitwiseAND(mask) == mask).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    n = found.count()
    pmi = F.log(F.col("n_et") * F.lit(float(n)) / (F.col("n_e") * F.col("n_t")))
    ratio = pmi / F.nullif(F.log(F.lit(float(max(n, 1))) / F.col("n_e")), F.lit(0.0))
    return (pairs.join(n_term, "term").join(n_entity, "entity").select("entity", "term", ratio.alias("ratio"))
            .filter(F.col("ratio") >= generalise))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def sanitised(text: Column, spans: Column, remove: float = REMOVE) -> Column:
    """The text with every span replaced by its kind in brackets; a term that
    gives its entity away for certain is removed.  Overlapping spans become one."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"),
        F.when(F.coalesce(s["ratio"] >= remove, F.lit(False)), F.lit("")).otherwise(F.element_at(names, s["kind"] + 1)).alias("mask"))))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def cut(a, b=None):
        return F.substr(text, (a + 1).cast("int"), (b - a).cast("int") if b is not None else F.lit(2147483647))

    def step(acc, s):
        apart = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], -s["back"]).alias("at"),
                        F.when(apart, F.concat(acc["out"], F.array(cut(acc["at"], s["start"]), s["mask"]))).otherwise(acc["out"]).alias("out"))

    whole = F.aggregate(ordered, zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), cut(acc["at"])))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
