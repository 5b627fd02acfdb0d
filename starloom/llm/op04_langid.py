"""Language identification by interpolated Kneser-Ney character models.

Counting: texts become runs of lower-case letters and single blanks; every
character 4-gram is one 64-bit number (four 16-bit code units). Each batch
counts its grams per language by sorting (numpy); Spark sums the counts. Lower
orders follow in Spark from the distinct grams, as Kneser-Ney asks: a shorter
gram counts the different characters before it.

Model: for each order a sorted array of hashed grams and, beside it, one row of
probabilities with a column per language; contexts likewise with their weight
for the shorter order. Grams are found by the top bits of the hash and a short
walk. Arrays of up to ``MAX_CELLS`` cells an order are broadcast. Larger models
stay in Spark: texts are dealt into blocks, the distinct grams of a block are
joined with the counts, and the block is scored by a model of the joined rows.
A block looks up nothing else, so predictions, scores and entropies are the same.

A text goes to the language of the lowest cross-entropy per character. It is
marked ``rejected`` if that is higher than the language's own texts explain. The
limit is calibrated on texts that the counts leave out, a second fold of the
training rows: for each language and class of lengths, the entropy that all but
``REJECT_SHARE`` of its texts there stay below.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_udf_of, code_points, id_bucket, ship, slabs, stored

ORDER = 4
#: Most (gram, language) cells of an order in a model that is broadcast.
MAX_CELLS = 1 << 23
#: Characters (about) of a block of texts that a larger model is joined with.
BLOCK_CHARS = 1 << 22
HELD_OUT_MOD, HELD_OUT_REST = 4, 2
UNKNOWN = "und"
#: Of the training rows, those with crc32 modulo 20 below 4 calibrate the rejection.
CALIBRATION_MOD, CALIBRATION_BELOW = 20, 4
#: Share of a language's own texts above its limit, and the texts that a class of
#: lengths (powers of 4 in characters) needs for a limit of its own; a language
#: with fewer texts in all has the limit of all languages' texts.
REJECT_SHARE, REJECT_TEXTS, LENGTH_CLASSES = 0.005, 200, 8
#: Characters' worth of evidence that turns entropies into a score.
SHARPNESS = 16.0
_BLANK = 32
_HASH = np.uint64(0x9E3779B97F4A7C15)
_CODES: list[np.ndarray] = []


def _codes() -> np.ndarray:
    """Code point -> its lower-case letter as a 16-bit code; no letter: blank.

    Letters above U+FFFF take, in order, the codes that no lower-case letter below
    has. These are some 18,000: enough for all scripts up to U+1FFFF; the rare
    ideographs above go round again."""
    if not _CODES:
        out = np.full(0x110000, _BLANK, np.uint64)
        every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
        low = {ord(m[0]): ord(m[0].lower()[0]) for m in regex.finditer(r"\p{L}", every)}
        used = set(low.values())
        free = [c for c in range(1, 0x10000) if c != _BLANK and c not in used]
        code = {c: c for c in used if c <= 0xFFFF}
        code |= {c: free[k % len(free)] for k, c in enumerate(sorted(c for c in used if c > 0xFFFF))}
        for c, l in low.items():
            out[c] = code[l]
        _CODES.append(out)
    return _CODES[0]


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed 4-grams ending at each kept character (0 pads the beginning), the
    bounds of each text's grams, and whether each text has a letter."""
    cp, offsets = code_points(texts)
    code = _codes()[cp]
    letter = code != _BLANK
    first = np.zeros(len(cp) + 1, bool)
    first[offsets[:-1]] = True
    first = first[:len(cp)]
    keep = letter.copy()  # a blank only after a letter
    keep[1:] |= ~letter[1:] & letter[:-1] & ~first[1:]
    kept = np.concatenate([[0], np.cumsum(keep)])[offsets]
    code = code[keep]
    place = np.arange(len(code)) - np.repeat(kept[:-1], np.diff(kept))
    gram = code.copy()
    for back in range(1, ORDER):
        older = np.zeros_like(code)
        older[back:] = code[:-back]
        older[place < back] = 0
        gram |= older << np.uint64(16 * back)
    return gram, kept, np.diff(np.concatenate([[0], np.cumsum(letter)])[offsets]) > 0


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) over all rows; summed per task piece before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)

        def frame(lang: str, parts: list) -> pd.DataFrame:
            keys, n = merged(parts)
            return pd.DataFrame({"lang": lang, "gram": keys.view(np.int64), "n": n})

        for b in batches:
            for lang, texts in b.groupby("lang")["text"]:
                parts = held.setdefault(lang, [])
                for block in slabs(texts):
                    parts.append(np.unique(grams_of(block)[0], return_counts=True))
                if sum(len(p[0]) for p in parts) > 1 << 20:
                    whole = merged(parts)
                    if len(whole[0]) > 1 << 19:
                        yield frame(lang, [whole])
                        whole = (whole[0][:0], whole[1][:0])
                    held[lang] = [whole]
        for lang, parts in held.items():
            yield frame(lang, parts)

    return (docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
            .where("lang IS NOT NULL AND text IS NOT NULL").mapInPandas(count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


class Table:
    """Sorted hashes of packed grams; ``find`` gives their places or -1."""

    def __init__(self, grams: np.ndarray):
        h = grams * _HASH  # odd factor: one to one
        self.order = np.argsort(h)
        self.keys = h[self.order]
        bits = max(1, int(len(grams)).bit_length() + 1)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.keys >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, grams: np.ndarray) -> np.ndarray:
        out = np.full(len(grams), -1, np.int64)
        if not len(self.keys):
            return out
        h = grams * _HASH
        top = (h >> self.shift).astype(np.int64)
        at, end = self.first[top].astype(np.int64), self.first[top + 1]
        live = np.flatnonzero(at < end)
        at, end, h = at[live], end[live], h[live]
        while len(live):
            hit = self.keys[at] == h
            out[live[hit]] = at[hit]
            at = at + 1
            go = ~hit & (at < end)
            live, at, end, h = live[go], at[go], end[go], h[go]
        return out


_LOW = [np.uint64((1 << 16 * n) - 1) if n < 4 else np.uint64(2**64 - 1) for n in range(ORDER + 1)]


@dataclass
class LanguageModel:
    langs: list[str]
    grams: list[Table]  # by order, from 1
    probs: list[np.ndarray]
    contexts: list[Table]
    weights: list[np.ndarray]

    def probabilities(self, gram: np.ndarray, order: int = ORDER) -> np.ndarray:
        """P(last character | those before) for every gram and language."""
        if order == 0:
            return np.full((len(gram), len(self.langs)), 1 / 0x10000, np.float32)
        at = self.grams[order - 1].find(gram & _LOW[order])
        out = self.probs[order - 1][at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            left = gram[miss]
            context = self.contexts[order - 1].find((left & _LOW[order]) >> np.uint64(16))
            weight = np.where((context >= 0)[:, None], self.weights[order - 1][context], 1)
            out[miss] = weight * self.probabilities(left, order - 1)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, score, entropy, kept characters) of each text."""
        gram, bounds, letters = grams_of(texts)
        n = np.diff(bounds)
        cost = np.concatenate([np.zeros((1, len(self.langs))), -np.log(self.probabilities(gram)).cumsum(axis=0, dtype=np.float64)])
        mean = (cost[bounds[1:]] - cost[bounds[:-1]]) / np.maximum(1, n)[:, None]
        best = mean.argmin(axis=1)
        low = mean[np.arange(len(texts)), best]
        score = 1 / np.exp(SHARPNESS * np.maximum(-40, low[:, None] - mean)).sum(axis=1)
        return [self.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters)], np.where(letters, score, 0.0), \
            np.where(letters, low, np.nan), n.astype(np.int64)


def _columns(df: DataFrame) -> dict[str, np.ndarray]:
    got = df.toArrow()
    return {c: np.array(got[c].to_pylist(), object) if c == "lang" else got[c].to_numpy() for c in got.column_names}


@dataclass
class Counts:
    """Gram counts in Spark, nothing left out."""

    langs: list[str]
    tables: list[DataFrame]  # (lang, gram, n) by order, from 1
    discounts: list[np.ndarray]  # by order, a number per language

    def contexts(self, order: int) -> DataFrame:
        """(lang, gram, total, kinds) of what stands before the last character."""
        context = F.shiftrightunsigned("gram", 16).alias("gram")
        return self.tables[order - 1].groupBy("lang", context).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))

    def per_language(self, values) -> Column:
        return F.create_map(*[F.lit(x) for pair in zip(self.langs, values) for x in pair])[F.col("lang")]


def counted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Counts | None:
    """The counts of all rows of ``docs`` with a language and a text (None if none)."""
    ship(docs.sparkSession)
    tables = [stored(gram_counts(docs, text_col, lang_col), "grams")]
    langs = sorted(r["lang"] for r in tables[0].select("lang").distinct().collect())  # as many as languages
    if not langs:
        return None
    for n in range(ORDER - 1, 0, -1):  # distinct characters before each shorter gram
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 16 * n) - 1))
        tables.insert(0, stored(tables[0].groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n")), "grams"))
    discounts = []
    for table in tables:
        discount = {r["lang"]: r["ones"] / (r["ones"] + 2 * r["twos"]) if r["ones"] else 0.5
                    for r in table.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"),
                                                       F.count_if(F.col("n") == 2).alias("twos")).collect()}
        discounts.append(np.array([min(0.95, discount[x]) for x in langs]))
    return Counts(langs, tables, discounts)


def assembled(langs: list[str], discounts: list[np.ndarray], parts: Iterator[tuple]) -> LanguageModel:
    """The model of gram rows: for each order (column, gram, total, kinds) of the
    contexts, then (column, gram, n); ``column`` is the place of the language."""
    model = LanguageModel(langs, [], [], [], [])
    none = np.ones((1, len(langs)))  # place -1
    for order, (d, (sums, rows)) in enumerate(zip(discounts, parts), 1):
        own, gram, totals, kind = sums
        where, at = np.unique(gram.view(np.uint64), return_inverse=True)
        total = np.zeros((len(where), len(langs)))
        kinds = np.zeros_like(total)
        total[at, own], kinds[at, own] = totals, kind
        weight = np.where(total > 0, d * kinds / np.maximum(1, total), 1)
        contexts = Table(where)

        own, gram, n = rows
        grams, at = np.unique(gram.view(np.uint64), return_inverse=True)
        of = contexts.find(grams >> np.uint64(16))  # every gram has its context
        seen = np.zeros((len(grams), len(langs)))
        seen[at, own] = n
        known = total[contexts.order][of]
        alpha = np.where(known > 0, np.maximum(seen - d, 0) / np.maximum(1, known), 0)
        p = alpha + weight[contexts.order][of] * model.probabilities(grams, order - 1)
        found = Table(grams)
        model.grams.append(found)
        model.probs.append(np.concatenate([p[found.order], none]).astype(np.float32))
        model.contexts.append(contexts)
        model.weights.append(np.concatenate([weight[contexts.order], none]).astype(np.float32))
    return model


def gathered(counts: Counts) -> LanguageModel:
    """The whole model in the driver."""
    column = {x: k for k, x in enumerate(counts.langs)}

    def arrays(df: DataFrame, *names: str) -> tuple:
        got = _columns(df)
        return np.array([column[x] for x in got["lang"]], np.int64), *(got[x] for x in names)

    return assembled(counts.langs, counts.discounts, (
        (arrays(counts.contexts(order), "gram", "total", "kinds"), arrays(table, "gram", "n"))
        for order, table in enumerate(counts.tables, 1)))


def by_blocks(rows: DataFrame, counts: Counts, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``rows`` (id, held_out, text) with the model's answers, where the model is
    joined with blocks of texts instead of broadcast."""
    langs, discounts = counts.langs, counts.discounts
    chars = rows.agg(F.sum(F.length("text").cast("long")).alias("n")).first()["n"] or 0
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(-(-chars // block_chars) or 1)))

    def needed(docs: pa.Table) -> pa.Table:
        gram = np.unique(np.concatenate([np.unique(grams_of(block)[0]) for block in slabs(docs["text"].to_pylist())]))
        part, keys = [], []
        for order in range(1, ORDER + 1):
            own = np.unique(gram & _LOW[order])
            for kind, key in ((order, own), (-order, np.unique(own >> np.uint64(16)))):
                part.append(np.full(len(key), kind, np.int32))
                keys.append(key)
        part, keys = np.concatenate(part), np.concatenate(keys)
        return pa.table({"block": np.full(len(keys), docs["block"][0].as_py()), "part": part, "gram": keys.view(np.int64)})

    column, zero = counts.per_language(range(len(langs))).alias("own"), F.lit(0).cast("long").alias("b")
    known = None
    for order, table in enumerate(counts.tables, 1):
        for some in (table.select(F.lit(order).alias("part"), "gram", column, F.col("n").alias("a"), zero),
                     counts.contexts(order).select(F.lit(-order).alias("part"), "gram", column,
                                                   F.col("total").alias("a"), F.col("kinds").alias("b"))):
            known = some if known is None else known.unionByName(some)
    found = dealt.groupBy("block").applyInArrow(needed, "block long, part int, gram long").join(known, ["part", "gram"])

    def score(docs: pa.Table, found: pa.Table) -> pa.Table:
        part, gram, own, a, b = (found[c].to_numpy() for c in ("part", "gram", "own", "a", "b"))

        def arrays(kind: int, *values: np.ndarray) -> tuple:
            at = np.flatnonzero(part == kind)
            return own[at], gram[at], *(v[at] for v in values)

        model = assembled(langs, discounts, ((arrays(-n, a, b), arrays(n, a)) for n in range(1, ORDER + 1)))
        out = [model.predict(block) for block in slabs(docs["text"].to_pylist())]
        lang, *numbers = zip(*out)
        return pa.table({"id": docs["id"], "held_out": docs["held_out"], "lang_pred": [x for one in lang for x in one],
                         **{c: pa.array(np.concatenate(x), from_pandas=True)  # no entropy: null
                            for c, x in zip(("score", "entropy", "kept"), numbers)}})

    kind = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "held_out"))
    return dealt.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        score, f"{kind}, lang_pred string, score double, entropy double, kept long")


def language(text: Column, model: Broadcast) -> Column:
    """struct<lang, score, entropy, kept> of ``text``: ``und`` with score 0
    for a null text, one without letters, or a model without languages."""

    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for block in slabs(texts):
                if model.value is None:
                    out.append(pd.DataFrame({"lang": [UNKNOWN] * len(block), "score": 0.0, "entropy": np.nan, "kept": 0}))
                else:
                    out.append(pd.DataFrame(dict(zip(("lang", "score", "entropy", "kept"), model.value.predict(block)))))
            yield pd.concat(out, ignore_index=True) if out else pd.DataFrame(
                {"lang": pd.Series([], dtype=object), "score": [], "entropy": [], "kept": pd.Series([], dtype=np.int64)})

    return arrow_udf_of(rows, "lang string, score double, entropy double, kept long")(text)


def _length_class() -> Column:
    """Powers of 4 in kept characters."""
    return F.least(F.floor(F.log2(F.greatest(F.col("kept"), F.lit(1))) / 2).cast("int"), F.lit(LENGTH_CLASSES - 1))


def limits(own: DataFrame, langs: list[str]) -> dict[str, list[float]]:
    """For each language the greatest accepted entropy by class of lengths, from
    left-out texts (lang, entropy, kept) scored as their own language."""
    quantile = F.percentile_approx("entropy", 1 - REJECT_SHARE, 10_000).alias("limit")
    own = own.where("NOT isnan(entropy)").withColumn("size", _length_class())
    # a row for each language and class
    got = own.rollup("lang", "size").agg(quantile, F.count(F.lit(1)).alias("n")).collect()
    found = {(r["lang"], r["size"]): r["limit"] for r in got if r["n"] >= REJECT_TEXTS or (r["lang"] is None and r["n"])}
    every = found.get((None, None), float("inf"))  # of all languages; without left-out texts nothing is rejected
    return {x: [found.get((x, size), found.get((x, None), every)) for size in range(LENGTH_CLASSES)] for x in langs}


def identify_languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       max_cells: int = MAX_CELLS) -> DataFrame:
    """One row per input row: the id, ``held_out``, ``lang_pred``, ``score``,
    ``entropy`` (nats per character), ``rejected``.

    The model learns from the texts and languages of rows whose id's crc32
    modulo 4 is not 2 (a null id does not take part): four in five are counted, the
    others calibrate the rejection. Only the text enters a prediction. Ties go to
    the first language by name. Repeated rows count as often as they occur. Empty
    input gives an empty result. ``max_cells`` decides how texts and grams come
    together, not which grams count.
    """
    held = id_bucket(id_col, HELD_OUT_MOD) == HELD_OUT_REST
    left_out = ~held & (id_bucket(id_col, CALIBRATION_MOD) < CALIBRATION_BELOW)
    counts = counted(df.where(~held & ~left_out), text_col, lang_col)
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(held, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"),
                     F.when(left_out, F.col(lang_col).cast("string")).alias("own"))
    if counts and counts.tables[-1].count() * len(counts.langs) > max_cells:  # shorter orders have no more rows
        def told(some: DataFrame) -> DataFrame:
            return by_blocks(some.drop("own"), counts)
    else:
        model = df.sparkSession.sparkContext.broadcast(counts and gathered(counts))

        def told(some: DataFrame) -> DataFrame:
            return some.select("id", "held_out", language(F.col("text"), model).alias("l")).select(
                "id", "held_out", F.col("l.lang").alias("lang_pred"), "l.score", "l.entropy", "l.kept")
    accepted = {}
    if counts:
        own = told(rows.where("own IS NOT NULL AND text IS NOT NULL").withColumn("id", F.col("own")))
        accepted = limits(own.where("lang_pred = id").select(F.col("id").alias("lang"), "entropy", "kept"), counts.langs)
    # languages times classes of lengths
    limit = F.get(F.create_map(*[F.lit(x) for lang, own in accepted.items() for x in (lang, own)])[F.col("lang_pred")], _length_class()) \
        if accepted else F.lit(float("inf"))
    return told(rows).select(F.col("id").alias(id_col), "held_out", "lang_pred", "score", "entropy",
                             ((F.col("lang_pred") == UNKNOWN) | (F.col("entropy") > limit)).alias("rejected"))
