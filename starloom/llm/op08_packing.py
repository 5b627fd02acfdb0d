"""Packing by power-of-two decomposition.

A document of T tokens (its ids and an end id) becomes floor(T / limit) pieces
of the full length and the binary digits of the rest, longest first. Each piece
is a sequence by itself; sequences of equal length form a bucket, so no
sequence crosses documents and none needs padding. One narrow pass.

Tokenising runs the tokenizer's merges as a transducer over bytes (one lane a
word part, in lockstep) and reads the ids off it; texts that hold a special token's string, or a character that the
tokenizer's Unicode tables take otherwise than Python's, go to the tokenizer itself.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain, repeat

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_transducer import LANES, Transducer, byte_letters, character_classes, contractions, utf8_widths
from .common import code_points, ship, slabs

LIMIT = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Stands for the end of a word; no UTF-8 text holds this byte.
_END = 0xFF


def odd_characters(raw: bytes) -> np.ndarray:
    """For every code point, whether the file's tokenizer may take it otherwise than
    ``WordTokenizer``: those that Python's Unicode tables do not know (the composed
    form of known ones never changes), and those whose normal form or class the
    tokenizer gives otherwise."""
    from tokenizers import Tokenizer

    library, ours = Tokenizer.from_str(raw.decode()), character_classes()
    normal, split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
    out = np.ones(0x110000, bool)
    known = [c for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    plain = []
    for c in known:
        own = WordTokenizer._plain(chr(c))
        if normal(chr(c)) == (" " if ours[c] == 3 else own):
            out[c] = False
            if own == chr(c):
                plain.append(c)

    def parts(chars: list[str]) -> np.ndarray:
        """How many parts each character makes between letters, and between signs."""
        n = np.zeros(2 * len(chars), np.int64)
        for at in range(0, len(chars), 2048):
            some = chars[at:at + 2048]
            starts = [span[0] for _, span in split("".join(f"a{c}a !{c}! " for c in some))]
            n[2 * at:2 * (at + len(some))] = np.bincount(np.array(starts) // 4, minlength=2 * len(some))
        return n.reshape(-1, 2)

    of_class = parts(["#", "b", "2", " "])  # in the order of the classes
    out[plain] |= (parts([chr(c) for c in plain]) != of_class[ours[plain]]).any(axis=1)
    return out


class WordTokenizer(Transducer):
    """Ids of whole texts as the file's tokenizer gives them: composed (NFC),
    lower case, white space dropped, word parts merged with an end mark. ``odd``
    (see ``odd_characters``) marks the characters that are left to the library."""

    def __init__(self, raw: bytes, odd: np.ndarray | None = None, **how):
        from tokenizers import Tokenizer

        spec, back = json.loads(raw), byte_letters()
        mark, special = spec["model"]["end_of_word_suffix"], [t["content"] for t in spec["added_tokens"]]

        def as_bytes(s: str) -> bytes:
            ends = s.endswith(mark)
            return bytes(map(back.__getitem__, s[:-len(mark)] if ends else s)) + bytes([_END]) * ends

        ids = {as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        ids.setdefault(bytes([_END]), -1)  # never left over
        # first of all, a word's last byte takes the mark; then the file's merges
        rank = {(bytes([b]), bytes([_END])): b - 256 for b in range(256) if bytes([b, _END]) in ids}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            rank[as_bytes(a), as_bytes(b)] = r
        super().__init__(ids, rank, **how)
        self.cls = character_classes()
        self.odd = odd_characters(raw) if odd is None else odd
        self.special = regex.compile("|".join(map(regex.escape, special)))
        self.library = Tokenizer.from_str(raw.decode())
        self.library.no_truncation()
        self.library.no_padding()

    @staticmethod
    def _plain(text: str) -> str:
        if text.isascii():
            return text.lower()
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # letter by letter where lower case depends on the place in the word
        return "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids (u32) of each text."""
        self.make_room()
        out: list = [None] * len(texts)
        own, parts = [], []
        cp, offsets = code_points(texts)
        strange = set((np.searchsorted(offsets, np.flatnonzero(self.odd[cp]), side="right") - 1).tolist())
        for i, t in enumerate(texts):
            if i in strange or "<|" in t and self.special.search(t):
                out[i] = np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4")
            else:
                own.append(i)
                parts.append(self._plain(t))
        cp, offsets = code_points(parts)
        n = len(cp)
        cls = self.cls[cp]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        end, first = first[1:], first[:n]
        word = cls != 3
        begins = word & (first | (cls != np.roll(cls, 1)) | (cls == 2))
        contractions(cp, begins, end)
        begins &= word
        # the bytes of all parts, without white space, each part followed by the mark
        widths = utf8_widths(cp)
        raw = np.frombuffer("".join(parts).encode("utf-8", "surrogatepass"), np.uint8)
        part = np.cumsum(begins)
        kept = np.repeat(word, widths)
        place = np.cumsum(kept) - 1 + np.repeat(part, widths) - 1
        n_parts = int(part[-1]) if n else 0
        data = np.full(int(kept.sum()) + n_parts, _END, np.uint8)
        data[place[kept]] = raw[kept]
        at = np.concatenate([[0], np.cumsum(widths)])
        starts = place[at[np.flatnonzero(begins)]]
        ends, ids = self.encode(data, starts, np.diff(np.append(starts, len(data))))
        part_at = np.searchsorted(offsets, np.flatnonzero(begins), side="right") - 1  # the text of each part
        text_start = np.append(starts, len(data))[np.searchsorted(part_at, np.arange(len(parts) + 1))]
        cut = np.searchsorted(ends, text_start)
        ids = ids.astype("<u4")
        for k, i in enumerate(own):
            out[i] = ids[cut[k]:cut[k + 1]]
        return out


def piece_lengths(n: int, limit: int = LIMIT) -> list[int]:
    """Full pieces, then the binary digits of the rest from the highest."""
    full, rest = divmod(n, limit)
    return [limit] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


_WORKER: dict[int, WordTokenizer] = {}


def word_tokenizer(model: bytes, odd: bytes) -> WordTokenizer:
    key = zlib.crc32(model)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = WordTokenizer(model, np.unpackbits(np.frombuffer(odd, np.uint8)).astype(bool))
    return _WORKER[key]


_ODD: dict[int, bytes] = {}


def _odd_bits(model: bytes) -> bytes:
    """``odd_characters``, found once on the driver: a bit for each code point."""
    key = zlib.crc32(model)
    if key not in _ODD:
        _ODD[key] = np.packbits(odd_characters(model)).tobytes()
    return _ODD[key]


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end_id: int = END_ID,
         keep_ids: bool = True, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: the id, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``, ``bucket`` and, if kept, ``ids``.

    ``bucket`` is the power of two that the length is: every sequence of a bucket has
    that length and takes no padding (``write_buckets`` lays them out so). A null or empty text is the end id alone. Repeated
    rows are packed like any row. Other columns are not read; empty input gives
    an empty result.
    """
    if limit < 1 or limit & (limit - 1):
        raise ValueError("the limit must be a power of two")
    ship(df.sparkSession)
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    with open(path, "rb") as f:  # a fixed vocabulary file, some 2 MB
        raw = f.read()
    model, odd = (df.sparkSession.sparkContext.broadcast(x) for x in (raw, _odd_bits(raw)))
    last = np.array([end_id], "<u4")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = word_tokenizer(model.value, odd.value)
        for b in batches:
            ids = iter(b["id"].tolist())
            for block in slabs(b["text"], LANES):
                found = [np.concatenate([x, last]) for x in words.ids(block)]
                cuts = [piece_lengths(len(x), limit) for x in found]
                many = [len(c) for c in cuts]
                out = {"id": pd.Series(list(chain.from_iterable(repeat(next(ids), n) for n in many)), dtype=object),
                       "start": [s for c in cuts for s in accumulate(c[:-1], initial=0)],
                       "length": [n for c in cuts for n in c]}
                parts = [x[s:s + n] for x, c in zip(found, cuts) for s, n in zip(accumulate(c[:-1], initial=0), c)]
                out |= {"ids_crc32": [zlib.crc32(p.tobytes()) for p in parts],
                        "doc_tokens": np.repeat([len(x) for x in found], many)}
                yield pd.DataFrame(out | ({"ids": [p.astype(np.int32) for p in parts]} if keep_ids else {}))

    # ids travel as text: pandas would turn a nullable long into a double
    docs = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    kind = "id string, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    out = docs.mapInPandas(rows, kind)
    return (out.select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), *out.columns[1:])
            .withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
            .withColumn("bucket", F.length(F.bin("length")) - 1))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write packed sequences in a folder for each bucket, so that a reader takes
    batches of one length. A bucket of many rows is split over tasks and files."""
    packed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
