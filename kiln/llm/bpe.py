"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut before the library sees them, only where no match of the
splitting pattern can cross: in front of a white-space character that follows
a non-white one.  A very long white-space run (the pattern's look-ahead
backtracks over it, and the library's stack overflows) is one match but for
its last character when text follows, so it is encoded as one piece.

Rules: a null text is the empty text (no tokens); texts are encoded whole;
special-token strings are ordinary text; rows are independent, so repeated
rows get equal ids; other columns pass through untouched."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: The Unicode White_Space property (fixed values): what ``\\s`` of the splitting pattern matches.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_BOUNDARY = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")
LONG_TEXT, LONG_RUN, OUT_BYTES = 65_536, 4_096, 8_000_000
_RUN = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")


@lru_cache(maxsize=4)
def encoding(rank_file: bytes, pattern: str):
    """The encoder of a rank file's content; one per Python worker."""
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, long_text: int = LONG_TEXT):
    """(part, is_one_match) in order; the parts make up the text."""
    if len(text) <= long_text:
        if len(text) > LONG_RUN and _RUN.search(text):
            long_text = len(text)
        else:
            yield text, False
            return
    at = 0
    for run in [*_RUN.finditer(text), None]:
        end = run.start() if run else len(text)
        while at < end:
            cut = _BOUNDARY.search(text, at + long_text, end) if end - at > long_text else None
            upto = cut.start() if cut else end
            yield text[at:upto], False
            at = upto
        if run:
            at = run.end() if run.end() == len(text) else run.end() - 1
            yield text[run.start():at], True


def encode_text(enc, text: str):
    """uint32 ids of a whole text."""
    import numpy as np
    parts = [np.asarray(enc._core_bpe.encode_single_piece(part.encode()), dtype=np.uint32) if one
             else enc.encode_to_numpy(part, disallowed_special=()) for part, one in pieces(text) if part]
    return parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, np.uint32), *parts])


def encode(df: DataFrame, rank_path: str, pattern: str, text: str = "text", keep: list[str] | None = None,
           ids: str = "ids", n_tokens: str = "n_tokens", decoded: str | None = None, digests: bool = False) -> DataFrame:
    """``keep`` columns plus ``ids`` (binary: little-endian uint32 tokens) and
    ``n_tokens``; with ``decoded`` also the bytes that the ids decode to.  With
    ``digests`` the two columns hold the lowercase hex sha256 of those bytes, taken
    where they are made, so that neither goes back to the JVM.

    The rank file is read on the driver and sent as one broadcast; its size is
    the vocabulary's, whatever the data."""
    spark = df.sparkSession
    with open(rank_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    keep = [c for c in (df.columns if keep is None else keep) if c not in (ids, n_tokens, decoded)]
    kind = T.StringType() if digests else T.BinaryType()
    fields = [df.schema[c] for c in keep] + [T.StructField(ids, kind), T.StructField(n_tokens, T.LongType())]
    if decoded:
        fields.append(T.StructField(decoded, kind))

    def run(batches):
        import pyarrow as pa
        from hashlib import sha256
        enc = encoding(ranks.value, pattern)
        names = [f.name for f in fields]
        arrow = pa.string() if digests else pa.binary()

        def made(data):
            return sha256(data).hexdigest() if digests else data

        for batch in batches:
            texts, at = batch.column(batch.num_columns - 1), 0
            while at < batch.num_rows:
                first, size, packed, counts, back = at, 0, [], [], []
                while at < batch.num_rows and size < OUT_BYTES:
                    tokens = encode_text(enc, texts[at].as_py() or "")
                    packed.append(made(tokens.astype("<u4").tobytes()))
                    counts.append(len(tokens))
                    if decoded:
                        back.append(made(enc.decode_bytes(tokens.tolist())))
                    size += len(packed[-1])
                    at += 1
                out = [batch.column(i).slice(first, at - first) for i in range(len(keep))]
                out += [pa.array(packed, arrow), pa.array(counts, pa.int64())]
                if decoded:
                    out.append(pa.array(back, arrow))
                yield pa.RecordBatch.from_arrays(out, names=names)

    # the text goes last and under a name of its own: ``keep`` may hold it too
    return df.select(*keep, df[text].alias("_bpe_text")).mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, rank_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds ``decoded``: the raw bytes of packed little-endian uint32 ids (null: empty)."""
    spark = df.sparkSession
    with open(rank_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    keep = [c for c in df.columns if c != decoded]
    at = keep.index(ids)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        enc = encoding(ranks.value, pattern)
        for batch in batches:
            back = [enc.decode_bytes(np.frombuffer(x.as_py() or b"", "<u4").tolist()) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(back, pa.binary())], names=[*keep, decoded])

    return df.select(*keep).mapInArrow(run, T.StructType([*(df.schema[c] for c in keep),
                                                          T.StructField(decoded, T.BinaryType())]))
