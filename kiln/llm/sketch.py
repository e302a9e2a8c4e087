"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is cut into paragraphs (lines; a line of more than ``PIECE`` words into
pieces of so many).  A paragraph's digest, with the number of equal ones
before it, is a key of the text's set.  A sketch of m cells, three sub-tables
of m/3, keeps per cell the number of keys, their sum and the sum of their
check hashes.  Subtracting two sketches cancels what both texts hold; peeling
the cells that hold one key recovers the differing digests of either side.
When peeling stops before the cells are empty, both sketches are built anew
with twice the cells or more, until it succeeds.

The likeness of two texts is the share of equal keys, |both| / |either|, from
the two set sizes and the number of recovered keys; two empty sets are alike
(1.0).  The fingerprint is the ``BASE``-cell sketch as text, so equal texts
have equal fingerprints.

The next document (descending id) comes from a range split of the ids: the
texts are shuffled once, sorted inside their range, and the first document of
each range also goes to the range before it.

Rules: a null text is the empty text; ids that are null come last; rows with
one id follow each other by a hash of the text; a single document is its own
next; an empty table gives an empty result."""

from __future__ import annotations

import base64
import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import small_table

PIECE, BASE, RANGE_ROWS, MAX_RANGES, CHUNK_CHARS = 8, 24, 2000, 4096, 1_000_000
_PIECES = re.compile(rb"[^\x20\x09-\x0D]+(?:[\x20\x09\x0B-\x0D]+[^\x20\x09-\x0D]+){0,%d}" % (PIECE - 1))


def _mix(x, seed: int):
    import numpy as np
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x2545F4914F6CDD1D) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sets:
    """The key sets of a list of texts: ``keys`` in text order, ``ends`` per text."""

    def __init__(self, texts: list[bytes]):
        import numpy as np
        import xxhash
        digests, sizes = [], []
        for t in texts:
            found = _PIECES.findall(t)
            digests.extend(map(xxhash.xxh3_64_intdigest, found))
            sizes.append(len(found))
        digest = np.array(digests, dtype=np.uint64)
        self.sizes = np.array(sizes, dtype=np.int64)
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        own = np.repeat(np.arange(len(texts)), self.sizes)
        order = np.lexsort((digest, own))
        d, o = digest[order], own[order]
        fresh = np.ones(len(d), bool)
        fresh[1:] = (d[1:] != d[:-1]) | (o[1:] != o[:-1])
        at = np.arange(len(d))
        before = at - np.maximum.accumulate(np.where(fresh, at, 0))
        self.keys = np.empty_like(digest)
        self.keys[order] = _mix(d + before.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 7)

    def of(self, which):
        """(position in ``which``, key) of all keys of the chosen texts."""
        import numpy as np
        n = self.sizes[which]
        start = np.repeat(self.ends[which] - np.concatenate([[0], np.cumsum(n)])[:-1], n)
        return np.repeat(np.arange(len(which)), n), self.keys[start + np.arange(n.sum())]


def _cells(keys, cells: int):
    """The three cells of each key, one per sub-table."""
    import numpy as np
    part = np.uint64(cells // 3)
    return [(_mix(keys, i + 1) % part + np.uint64(i) * part).astype(np.int64) for i in range(3)]


def _add(table, row, keys, sign, cells: int):
    import numpy as np
    count, total, check = (x.reshape(-1) for x in table)
    unsigned = sign.astype(np.int64).view(np.uint64)
    signed, mark = keys * unsigned, _mix(keys, 9) * unsigned
    for c in _cells(keys, cells):
        at = row * cells + c
        np.add.at(count, at, sign)
        np.add.at(total, at, signed)
        np.add.at(check, at, mark)


def sketches(sets: Sets, which, cells: int):
    """(counts, key sums, check sums), one row per chosen text."""
    import numpy as np
    table = (np.zeros((len(which), cells), np.int64), np.zeros((len(which), cells), np.uint64), np.zeros((len(which), cells), np.uint64))
    row, keys = sets.of(which)
    _add(table, row, keys, np.ones(len(keys), np.int64), cells)
    return table


def peel(table, cells: int):
    """Empties difference sketches in place.  (row, key, side) of the recovered
    keys, and which rows came out empty."""
    import numpy as np
    count, total, check = table
    live, rows, keys, sides = np.arange(len(count)), [], [], []
    while len(live):
        c = count[live]
        at, cell = np.nonzero((c == 1) | (c == -1))
        r = live[at]
        side = count[r, cell]
        sign = side.view(np.uint64)
        key = total[r, cell] * sign
        pure = _mix(key, 9) == check[r, cell] * sign
        r, key, side = r[pure], key[pure], side[pure]
        if not len(r):
            break
        _, one = np.unique(_mix(key, 3) ^ _mix(r.astype(np.uint64), 4), return_index=True)  # a key can be alone in several cells
        r, key, side = r[one], key[one], side[one]
        _add(table, r, key, -side, cells)
        rows.append(r)
        keys.append(key)
        sides.append(side)
        live = np.unique(r)
    done = ~(count.any(axis=1) | total.any(axis=1) | check.any(axis=1))
    some = [np.concatenate(x) if x else np.empty(0, t) for x, t in ((rows, np.int64), (keys, np.uint64), (sides, np.int64))]
    return (*some, done)


def differences(a: Sets, ia, b: Sets, ib):
    """The number of keys in which the texts ``ia`` of ``a`` and ``ib`` of ``b`` differ, pairwise."""
    import numpy as np
    out = np.zeros(len(ia), np.int64)
    todo, cells = np.arange(len(ia)), BASE
    while len(todo):
        ta, tb = sketches(a, ia[todo], cells), sketches(b, ib[todo], cells)
        table = tuple(x - y for x, y in zip(ta, tb))
        rows, _, _, done = peel(table, cells)
        out[todo[done]] = np.bincount(rows, minlength=len(todo))[done]
        todo, cells = todo[~done], cells * 2
    return out


def likeness(a: Sets, ia, b: Sets, ib):
    import numpy as np
    total, d = a.sizes[ia] + b.sizes[ib], differences(a, ia, b, ib)
    return np.where(total == 0, 1.0, (total - d) / np.maximum(total + d, 1))


def written(sets: Sets, n: int) -> list[str]:
    """The fingerprints of the first n texts: set size, cells and the cells' bytes."""
    import numpy as np
    count, total, check = sketches(sets, np.arange(n), BASE)
    packed = np.zeros((n, BASE), np.dtype([("n", "<i4"), ("key", "<u8"), ("check", "<u4")]))
    packed["n"], packed["key"], packed["check"] = count, total, check & np.uint64(0xFFFFFFFF)
    return [f"{size}:{BASE}:{base64.b64encode(x.tobytes()).decode()}" for size, x in zip(sets.sizes[:n].tolist(), packed)]


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def neighbours(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text, border) in partitions of consecutive descending ids, each
    ended by the first document of the next one (border)."""
    spark = docs.sparkSession
    from pyspark.ml.feature import Bucketizer
    order = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    ids = docs.select(order.alias("_k"))
    n = ids.count()
    wanted = min(MAX_RANGES, -(-n // RANGE_ROWS))
    cuts = ids.agg(F.percentile_approx("_k", [i / wanted for i in range(1, wanted)], 100 * wanted)).first()[0] if wanted > 1 else []
    splits = [float("-inf"), *sorted({float(c) for c in [*(cuts or []), 0.0]}), float("inf")]
    ranges = Bucketizer(splits=splits, inputCol="_d", outputCol="_p")

    def ranged(df):
        return ranges.transform(df.withColumn("_d", F.col("_k").cast("double")))

    first = {int(r["_p"]): r["top"] for r in ranged(ids).groupBy("_p").agg(F.max("_k").alias("top")).collect()}  # one number per range
    down = sorted(first, reverse=True)
    borders = small_table(spark, [{"_first": first[p], "_to": down[i - 1]} for i, p in enumerate(down)], "_first: bigint, _to: int")
    rows = ranged(docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"), order.alias("_k")))
    sent = rows.join(F.broadcast(borders), F.col("_k") == F.col("_first"), "left").withColumn("_go", F.explode(F.array_compact(F.array(
        F.struct(F.col("_p").cast("int").alias("p"), F.lit(False).alias("border")),
        F.when(F.col("_to").isNotNull(), F.struct(F.col("_to").alias("p"), F.lit(True).alias("border")))))))
    return (sent.select("id", "t", "_k", "_go.p", "_go.border").repartitionById(max(1, len(splits) - 1), F.col("p"))
            .sortWithinPartitions("border", F.desc("_k"), F.desc(F.xxhash64("t"))).select("id", "t", "border"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, and n_paragraphs."""
    def out_of(ids, texts):
        """Rows for all texts but the last, which only is the next of the one before."""
        import numpy as np
        import pyarrow as pa
        n = len(texts) - 1
        changed = [edited(t, texts[i + 1]).encode() for i, t in enumerate(texts[:-1])]
        own, new, at = Sets([t.encode() for t in texts]), Sets(changed), np.arange(n)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[:n], kind), pa.array([len(t) for t in texts[:n]], pa.int64()),
             pa.array([hashlib.sha256(c).hexdigest() for c in changed]), pa.array(written(own, n)), pa.array(written(new, n)),
             pa.array(likeness(own, at, new, at)), pa.array(likeness(own, at, own, at + 1)), pa.array(own.sizes[:n])],
            names=[key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_paragraphs"])

    from pyspark.sql.pandas.types import to_arrow_type
    field = docs.schema[key]
    kind = to_arrow_type(field.dataType)

    def run(batches):
        ids, texts, size, over = [], [], 0, False
        for batch in batches:
            for i in range(batch.num_rows):
                if over:
                    break
                over = batch.column(2)[i].as_py()
                texts.append(batch.column(1)[i].as_py())
                ids.append(batch.column(0)[i].as_py())
                size += len(texts[-1])
                if (size >= CHUNK_CHARS or over) and len(texts) > 1:
                    yield out_of(ids, texts)
                    ids, texts, size = ids[-1:], texts[-1:], 0

    schema = (f"`{key}` {field.dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double, n_paragraphs long")
    return neighbours(docs, key, text).mapInArrow(run, schema)
