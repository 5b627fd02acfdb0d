"""Token counts by a compiled finite-state tokenizer.

Pre-tokenisation: whether a pre-token begins at a character depends on the
character, one before and three after it, so boundaries come from class arrays.

Merging: byte-pair encoding runs as a deterministic transducer over bytes whose
transitions are annotated with the change of the token count (bpe_transducer.py).

Long texts are cut into chunks. A chunk yields a state map (entry state ->
exit state, tokens counted); maps are associative and compose pairwise in a
prefix-scan tree. The entry states are those that the context before the cut
admits; if a composed chain enters a chunk in another state (one pre-token
longer than the context), that chunk is run again from it.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_transducer import LANES, Transducer, byte_letters, character_classes, contractions, utf8_widths
from .common import code_points, ship, slabs

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
CHUNK, CONTEXT = 1 << 16, 512
_LOOK = 3
_PHASES = 16


class TokenCounter(Transducer):
    """The transducer of a byte-level tokenizer file, with its pre-tokenisation."""

    def __init__(self, raw: bytes, **how):
        spec, back = json.loads(raw), byte_letters()
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        as_bytes = lambda s: bytes(map(back.__getitem__, s))
        pairs = (p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"])
        super().__init__({as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in special},
                         {(as_bytes(a), as_bytes(b)): r for r, (a, b) in enumerate(pairs)}, **how)
        self.cls = character_classes()

    def boundaries(self, cp: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """True where a pre-token begins; ``offsets``: bounds of the texts."""
        n = len(cp)
        cls = self.cls[cp]
        first = np.zeros(n + 1, bool)
        first[offsets[:-1]] = True
        first[n] = True
        first, end = first[:n], first[1:]
        prev, nxt = np.roll(cls, 1), np.roll(cls, -1)
        space = cls == 3
        begins = first | (cls != prev)
        begins &= ~(~space & ~first & (np.roll(cp, 1) == 32))  # a blank goes with what follows
        begins |= space & ~first & (prev == 3) & ~end & (nxt != 3)  # the last of a run of white space
        contractions(cp, begins, end)
        return begins

    def count(self, texts: list[str]) -> np.ndarray:
        """Token counts of ``texts``."""
        self.make_room()
        parts, owner, out = [], [], np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            own = self.special.split(t) if self.special else [t]
            out[i] = len(own) - 1
            for p in own:
                if p:
                    parts.append(p)
                    owner.append(i)
        if not parts:
            return out
        cp, offsets = code_points(parts)
        begins = self.boundaries(cp, offsets)
        width = utf8_widths(cp)
        byte_at = np.concatenate([[0], np.cumsum(width)])
        data = np.frombuffer("".join(parts).encode("utf-8", "surrogatepass"), np.uint8)
        start_cp = np.flatnonzero(begins)
        starts = byte_at[start_cp]
        _, counts = self.run(data, starts, np.diff(np.append(starts, len(data))))
        of = np.array(owner)[np.searchsorted(offsets, start_cp, side="right") - 1]
        np.add.at(out, of, counts)
        return out

    def chunk_map(self, left: str, body: str, right: str, first: bool, last: bool) -> tuple[list[tuple], bool]:
        """The state map of ``body`` as (entry key, exit key, tokens), and whether
        its entry is proven (a boundary lies in the context)."""
        cp, offsets = code_points([left + body + right])
        begins = self.boundaries(cp, offsets)
        if not first:
            begins[:_LOOK] = False
        width = utf8_widths(cp)
        at = np.concatenate([[0], np.cumsum(width)])
        data = np.frombuffer((left + body + right).encode("utf-8", "surrogatepass"), np.uint8)
        a, b = len(left), len(left) + len(body)
        inside = np.flatnonzero(begins[a:b]) + a
        before = np.flatnonzero(begins[:a])
        proven = first or bool(len(before)) or (len(inside) > 0 and inside[0] == a)
        if len(inside) and inside[0] == a:
            entry = np.array([0])
            head_end = a
        else:
            warm = before[-1:] if len(before) else np.arange(min(_PHASES, a))
            entry, _ = self.run(data, at[warm], at[a] - at[warm])
            entry = np.unique(entry) if len(warm) else np.array([0])
            head_end = int(inside[0]) if len(inside) else b
        head_state, head_count = self.run(data, np.full(len(entry), at[a]), np.full(len(entry), at[head_end] - at[a]), entry)
        if not len(inside):
            return [(self.keys[e], self.keys[s], int(c)) for e, s, c in zip(entry, head_state, head_count)], proven
        starts = at[inside]
        states, counts = self.run(data, starts, np.diff(np.append(starts, at[b])))
        total, leave = int(counts.sum()), self.keys[int(states[-1])]
        if begins[b:b + 1].any() or (last and b == len(cp)):
            leave = self.keys[0]  # the cut is a boundary
        return [(self.keys[e], leave, int(c) + total) for e, c in zip(entry, head_count)], proven

    def rerun(self, key: tuple, left: str, body: str, right: str, first: bool, last: bool) -> tuple[tuple, int]:
        """Exit key and tokens of a chunk entered in state ``key``."""
        cp, offsets = code_points([left + body + right])
        begins = self.boundaries(cp, offsets)
        a, b = len(left), len(left) + len(body)
        data = np.frombuffer((left + body + right).encode("utf-8", "surrogatepass"), np.uint8)
        width = utf8_widths(cp)
        at = np.concatenate([[0], np.cumsum(width)])
        inside = np.flatnonzero(begins[a:b]) + a
        starts = np.concatenate([[at[a]], at[inside[inside > a]]])
        entry = np.zeros(len(starts), np.int64)
        entry[0] = self.state(key) if not (len(inside) and inside[0] == a) else 0
        states, counts = self.run(data, starts, np.diff(np.append(starts, at[b])), entry)
        over = bool(begins[b:b + 1].any()) or (last and b == len(cp))
        return self.keys[0] if over else self.keys[int(states[-1])], int(counts.sum())


def composed(f: dict, g: dict) -> dict:
    """First ``f``, then ``g`` (maps: entry -> (exit, tokens))."""
    return {e: (g[x][0], c + g[x][1]) for e, (x, c) in f.items() if x in g}


def scan(maps: list[dict]) -> dict:
    """All maps in order, composed pairwise in a tree."""
    while len(maps) > 1:
        maps = [composed(maps[i], maps[i + 1]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return maps[0]


_WORKER: dict[int, TokenCounter] = {}


def transducer(raw: bytes) -> TokenCounter:
    key = zlib.crc32(raw)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = TokenCounter(raw)
    return _WORKER[key]


def chunks(text: str, special, size: int, context: int) -> Iterator[dict]:
    """Chunks of every stretch between special tokens, with their context."""
    at = 0
    for s, part in enumerate(special.split(text) if special else [text]):
        for k in range(0, max(1, len(part)), size):
            yield {"stretch": s, "start": at + k, "first": k == 0, "last": k + size >= len(part),
                   "left": part[max(0, k - context):k], "body": part[k:k + size], "right": part[k + size:k + size + _LOOK]}
        at += len(part)


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT,
                 tokenizer: str | None = None, chunk: int = CHUNK, context: int = CONTEXT) -> DataFrame:
    """One row per input row: the id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    Null and empty texts have 0 of both. A special token's string inside a text
    counts one token and parts what stands around it. Rows with equal ids are
    counted apart; other columns are not read; empty input gives no rows.
    """
    spark = df.sparkSession
    ship(spark)
    with open(tokenizer or public_tokenizers.path(TOKENIZER), "rb") as f:  # a fixed vocabulary, under 2 MB
        raw = spark.sparkContext.broadcast(f.read())
    # ids travel as text: pandas would turn a nullable long into a double
    docs = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    kind = "id string, n_bytes long, n_tokens long"

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = transducer(raw.value)
        for b in batches:
            counts = [own.count(block) for block in slabs(b["text"], LANES)]
            yield pd.DataFrame({"id": b["id"], "n_bytes": [len((t or "").encode()) for t in b["text"]],
                                "n_tokens": np.concatenate([*counts, np.zeros(0, np.int64)])})

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        special = transducer(raw.value).special
        for b in batches:
            for i, row, t in zip(b["id"], b["row"], b["text"]):
                for c in chunks(t, special, chunk, context):
                    yield pd.DataFrame({"id": pd.Series([i], dtype=object), "row": [row]} | {k: [v] for k, v in c.items()})

    def mapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = transducer(raw.value)
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                own.make_room()
                pairs, proven = own.chunk_map(r.left, r.body, r.right, r.first, r.last)
                out.append((r.id, r.row, r.stretch, r.start, len(r.body.encode()), [repr(p) for p in pairs],
                            None if proven else repr((r.left, r.body, r.right, r.first, r.last))))
            yield pd.DataFrame(out, columns=["id", "row", "stretch", "start", "n_bytes", "pairs", "again"]).astype({"id": object})

    def combine(parts: pd.DataFrame) -> pd.DataFrame:
        from ast import literal_eval

        n_tokens, n_bytes = -1, 0
        for _, p in parts.sort_values(["stretch", "start"]).groupby("stretch", sort=True):
            maps = [{e: (x, c) for e, x, c in map(literal_eval, pairs)} for pairs in p["pairs"]]
            start = ((b"", None, 0),)
            got = scan(maps).get(start)
            if got is None:  # a chunk was entered in a state outside its map
                own, state, total = transducer(raw.value), start, 0
                for m, again in zip(maps, p["again"]):
                    state, c = m[state] if state in m else own.rerun(state, *literal_eval(again))
                    total += c
                got = (state, total)
            n_tokens += 1 + got[1]
            n_bytes += int(p["n_bytes"].sum())
        if n_tokens and len(set(parts["stretch"])) > 1:
            n_bytes += _special_bytes(transducer(raw.value), int(parts["stretch"].max()))
        return pd.DataFrame({"id": pd.Series([parts["id"].iloc[0]], dtype=object), "n_bytes": [n_bytes], "n_tokens": [n_tokens]})

    one = F.coalesce(F.length("text") <= chunk, F.lit(True))
    short = docs.where(one).mapInPandas(whole, kind)
    head = kind.split(", ")[0]
    long = (docs.where(~one).withColumn("row", F.monotonically_increasing_id())
            .mapInPandas(cut, head + ", row long, stretch long, start long, first boolean, last boolean, left string, body string, right string")
            .repartition("row", "start", "stretch")
            .mapInPandas(mapped, head + ", row long, stretch long, start long, n_bytes long, pairs array<string>, again string")
            .groupBy("row").applyInPandas(combine, kind))
    return short.unionByName(long).select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), "n_bytes", "n_tokens",
                                          (F.col("n_tokens") > limit).alias("over_limit"))


def _special_bytes(own: TokenCounter, times: int) -> int:
    """Bytes of ``times`` special strings (the vocabulary has one)."""
    return times * len(regex.sub(r"\\(.)", r"\1", own.special.pattern).encode())
