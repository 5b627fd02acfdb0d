"""Byte-level BPE encoding and decoding by overlapping chunks.

Pre-tokenisation looks forward only, so from a boundary that two overlapping
chunks share, both continue alike. Long texts are cut into chunks that overlap;
the chunks are spread over the cluster and pre-tokenised in parallel; the parts
of one text are stitched where the boundaries of neighbours meet in the overlap,
and the pieces are encoded. Two neighbours that share no boundary (one piece
longer than the overlap) are split again over their joined text, so the result
never depends on the cuts. Texts of one chunk need no stitching and no shuffle.

Decoding concatenates the raw bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

RANKS = "byte_bpe_50k.tiktoken"
CHUNK, OVERLAP = 1 << 16, 1 << 10
#: Pieces kept per worker; the table is emptied when full.
KNOWN_PIECES = 200_000
#: A boundary this close to a cut may depend on what follows the cut.
_LOOK = 4


def load_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


class Codec(dict):
    """Piece -> (number of ids, ids as decimal text, decoded bytes)."""

    def __init__(self, raw: bytes, capacity: int = KNOWN_PIECES):
        import tiktoken

        super().__init__()
        ranks = load_ranks(raw)
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.capacity = capacity

    def __missing__(self, piece: str) -> tuple[int, str, bytes]:
        ids = self.encoding.encode_ordinary(piece)
        got = len(ids), " ".join(map(str, ids)), self.decode(ids)
        if len(self) >= self.capacity:
            self.clear()
        self[piece] = got
        return got

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def boundaries(self, text: str) -> np.ndarray:
        """Ends of the pieces of ``text``."""
        return np.cumsum([len(p) for p in self.pieces(text)], dtype=np.int64)

    def encoded(self, pieces: list[str]) -> tuple[int, str, bytes]:
        got = list(map(self.__getitem__, pieces))
        return sum(g[0] for g in got), " ".join([g[1] for g in got]), b"".join([g[2] for g in got])


_WORKER: dict[int, Codec] = {}


def codec(raw: bytes) -> Codec:
    key = zlib.crc32(raw)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Codec(raw)
    return _WORKER[key]


def stitched(own: Codec, chunks: list[tuple[int, str, np.ndarray, bool]]) -> list[str]:
    """Pieces of the whole text from its chunks in order: (start, text, piece
    ends relative to start, last?)."""
    out: list[str] = []
    start, text, ends, last = chunks[0]
    done = start  # all pieces up to here are in out
    for nxt in [*chunks[1:], None]:
        sure = ends + start
        if not last:
            sure = sure[sure <= start + len(text) - _LOOK]
        if nxt is None:
            for e in sure[sure > done]:
                out.append(text[done - start:e - start])
                done = int(e)
            break
        theirs = np.concatenate([[nxt[0]], nxt[2] + nxt[0]])
        if not nxt[3]:
            theirs = theirs[theirs <= nxt[0] + len(nxt[1]) - _LOOK]
        both = np.intersect1d(np.append(sure, done), theirs)
        both = both[both >= done]
        if len(both):
            meet = int(both[0])
            for e in sure[(sure > done) & (sure <= meet)]:
                out.append(text[done - start:e - start])
                done = int(e)
            start, text, ends, last = nxt
        else:  # no shared boundary: split the joined rest again
            for e in sure[sure > done][:-1]:
                out.append(text[done - start:e - start])
                done = int(e)
            text = (text[done - start:nxt[0] - start] if done < nxt[0] else "") + nxt[1][max(0, done - nxt[0]):]
            start, last = done, nxt[3]
            ends = own.boundaries(text)
    return out


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
           chunk: int = CHUNK, overlap: int = OVERLAP, digests: bool = False) -> DataFrame:
    """One row per input row: the id, ``n_tokens``, and ``ids`` (array<int>) with
    ``decoded`` (binary, the bytes of the ids) - or, with ``digests``, their
    sha256 in ``ids_sha256`` and ``decoded_sha256``.

    Null counts as empty: no ids. Rows with equal ids are encoded apart. Further
    columns are not read; empty input gives an empty result.
    """
    spark = df.sparkSession
    ship(spark)
    with open(ranks or public_tokenizers.path(RANKS), "rb") as f:  # a fixed vocabulary, under 1 MB
        raw = spark.sparkContext.broadcast(f.read())
    kind = "id string, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary")

    def results(ids: list, pieces: Iterator[list[str]]) -> pd.DataFrame:
        own, out = codec(raw.value), []
        for p in pieces:
            n, text, data = own.encoded(p)
            out.append((n, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(data).hexdigest()) if digests
                       else (n, np.array(text.split(), np.int32), data))
        a, b = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")
        return pd.DataFrame({"id": pd.Series(ids, dtype=object), "n_tokens": [x[0] for x in out],
                             a: [x[1] for x in out], b: [x[2] for x in out]})

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(raw.value)
        for b in batches:
            yield results(list(b["id"]), (own.pieces(t or "") for t in b["text"]))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, row, t in zip(b["id"], b["row"], b["text"]):
                at = range(0, len(t), chunk)
                for k in at:
                    yield pd.DataFrame({"id": pd.Series([i], dtype=object), "row": [row], "start": [k],
                                        "last": [k == at[-1]], "text": [t[k:k + chunk + overlap]]})

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(raw.value)
        for b in batches:
            yield b.assign(ends=[own.boundaries(t) for t in b["text"]])

    def join(parts: pd.DataFrame) -> pd.DataFrame:
        own, p = codec(raw.value), parts.sort_values("start")
        chunks = [(int(s), t, np.asarray(e, np.int64), bool(x)) for s, t, e, x in
                  zip(p["start"], p["text"], p["ends"], p["last"])]
        return results(list(p["id"][:1]), iter([stitched(own, chunks)]))

    # ids travel as text: pandas would turn a nullable long into a double
    docs = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    one = F.coalesce(F.length("text") <= chunk, F.lit(True))
    short = docs.where(one).mapInPandas(whole, kind)
    part = kind.split(", ")[0] + ", row long, start long, last boolean, text string"
    long = (docs.where(~one).withColumn("row", F.monotonically_increasing_id()).mapInPandas(cut, part)
            .repartition("row", "start").mapInPandas(split, part + ", ends array<long>")
            .groupBy("row").applyInPandas(join, kind))
    out = short.unionByName(long)
    return out.select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), *out.columns[1:])


def decode(df: DataFrame, ids_col: str = "ids", ranks: str | None = None, out_col: str = "decoded") -> DataFrame:
    """``df`` with ``out_col``: the bytes of each id array (null or empty: no
    bytes; an id outside the vocabulary fails)."""
    from .common import arrow_udf_of

    with open(ranks or public_tokenizers.path(RANKS), "rb") as f:
        raw = df.sparkSession.sparkContext.broadcast(f.read())

    def rows(arrays: pd.Series) -> pd.Series:
        own = codec(raw.value)
        return pd.Series([own.decode([] if a is None else a) for a in arrays], dtype=object)

    return df.withColumn(out_col, arrow_udf_of(rows, "binary")(F.col(ids_col)))
