"""Divergence of sources by single-pass in-memory indexing (SPIMI; Heinz and
Zobel, 2003).

Build: a task counts the terms of its documents in memory, by (lang, source),
until ``ENTRIES_IN_MEMORY`` entries (or ``BYTES_IN_MEMORY`` of text) are gathered;
then it spills a run: the block's postings sorted by term, cut into the hash
shards of the terms and there into pages of bounded size. Spark's shuffle carries
the pages, a shard to a task.

Merge: a shard's pages arrive in the order of their first terms and are opened
until a bounded number of postings is held; a heap merges what the open pages have
below the first term of the next. Equal terms of all runs meet and are summed: the
frequencies, stored one row for each term and source, of the terms in enough
documents.

Divergence: summed over all kept terms, most of which neither or one of two
sources has. With every count 0 the sum is V equal parts; what one source's terms
add to it depends on their counts only, so it is summed over the source's
distinct counts; and the posting lists are streamed once for the corrections of
pairs, the terms that both have. All in whole numbers, exact.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import PIECE_CHARS, ship, stored

MIN_DOCS = 3
TOP_TERMS = 200
UNIT = 1_000_000_000
#: A block is spilled as a run when it has as many (lang, source, term) entries, or
#: has read as many bytes of texts.
ENTRIES_IN_MEMORY = 1_000_000
BYTES_IN_MEMORY = 256 << 20
ENTRIES_PER_PAGE = 4096
#: Characters of texts that are counted at once.
SLAB_CHARS = 4 * PIECE_CHARS
#: Bytes below 128 that are letters stay (in lower case); all others end a term.
_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def term_lists(text: str | None, chars: int = PIECE_CHARS) -> Iterator[list[bytes]]:
    """The terms of a text in order (UTF-8, A-Z in lower case), in pieces that
    cut no term: runs of characters other than ASCII that is not a letter."""
    rest = b""
    text = text or ""
    for at in range(0, len(text), chars):
        flat = rest + text[at:at + chars].encode("utf-8", "surrogatepass").translate(_LETTERS)
        cut = flat.rfind(b" ") + 1
        rest = flat[cut:]
        yield flat[:cut].split()
    if rest:
        yield [rest]


class Block:
    """Postings of a task's documents in memory: for each (group, term) of a slab of
    texts the occurrences and the documents that have it, as arrays; terms are
    numbered by their place in the slabs' dictionaries."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.names: list[pa.Array] = []
        self.parts: list[tuple[np.ndarray, ...]] = []  # group, term, occurrences, documents
        self.read = self.entries = self.known = 0

    def group(self, lang: str, source: str) -> int:
        return self.groups.setdefault((lang, source), len(self.groups))

    def _add(self, names: pa.Array, group: np.ndarray, term: np.ndarray, n: np.ndarray, d: np.ndarray) -> None:
        self.names.append(names)
        self.parts.append((group, term + self.known, n, d))
        self.known += len(names)
        self.entries += len(group)

    def add(self, texts: list[str], groups: list[int]) -> None:
        """Count whole texts, all words at once."""
        raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        flat = np.frombuffer(b" ".join(raws).translate(_LETTERS), np.uint8)
        self.read += len(flat)
        letter = flat != 32
        edges = np.flatnonzero(np.diff(np.concatenate([[0], letter.view(np.int8), [0]])))
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            return
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(flat[letter])]).dictionary_encode()
        many = len(words.dictionary)
        doc = np.searchsorted(np.cumsum([len(r) + 1 for r in raws]), starts, side="right")
        in_doc, n = np.unique(doc * many + words.indices.to_numpy(), return_counts=True)
        key, at = np.unique(np.array(groups, np.int64)[in_doc // many] * many + in_doc % many, return_inverse=True)
        self._add(words.dictionary, key // many, key % many, np.bincount(at, n, len(key)).astype(np.int64), np.bincount(at, minlength=len(key)))

    def add_long(self, text: str, group: int) -> None:
        """Count one text piece by piece."""
        counts: Counter = Counter()
        for terms in term_lists(text):
            counts.update(terms)
        self.read += len(text)
        n = np.fromiter(counts.values(), np.int64, len(counts))
        self._add(pa.array(list(counts), pa.binary()), np.full(len(n), group), np.arange(len(n)), n, np.ones(len(n), np.int64))

    def pages(self, shards: int, run: int) -> Iterator[dict]:
        """The postings as a run: term-sorted pages of one shard and language each."""
        if not self.entries:
            return
        one = pa.concat_arrays(self.names).dictionary_encode()
        order = pc.sort_indices(one.dictionary).to_numpy().astype(np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        names = one.dictionary.take(pa.array(order))
        group, term, n, d = (np.concatenate(x) for x in zip(*self.parts))
        key, at = np.unique((group << 40) | rank[one.indices.to_numpy()[term]], return_inverse=True)
        group, term, n, d = key >> 40, key & ((1 << 40) - 1), *(np.bincount(at, x, len(key)).astype(np.int64) for x in (n, d))
        listed, hashed = names.to_pylist(), _hashes(names)
        for lang in sorted({x for x, _ in self.groups}):
            own = sorted((source, g) for (x, source), g in self.groups.items() if x == lang)
            code = np.full(len(self.groups), -1, np.int32)
            code[[g for _, g in own]] = np.arange(len(own))
            some = np.flatnonzero(code[group] >= 0)
            if len(some):
                salt = np.uint64(zlib.crc32(lang.encode("utf-8", "surrogatepass")))
                shard = ((hashed ^ salt) * _MIX >> np.uint64(32)) % np.uint64(shards)
                yield from _pages_of(lang, [s for s, _ in own], listed, shard.astype(np.int32), code[group[some]], term[some], n[some], d[some], run)


_MIX = np.uint64(0x9E3779B97F4A7C15)
_WEIGHTS = np.random.default_rng(12).integers(1, 1 << 63, 256).astype(np.uint64) | np.uint64(1)


def _hashes(names: pa.Array) -> np.ndarray:
    """A hash of each name that depends on its bytes only."""
    ends = np.frombuffer(names.buffers()[1], np.int32)[names.offset:names.offset + len(names) + 1].astype(np.int64)
    data = np.frombuffer(names.buffers()[2], np.uint8)[ends[0]:ends[-1]].astype(np.uint64)
    place = np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], np.diff(ends))
    h = np.add.reduceat(data * _WEIGHTS[place & 255], ends[:-1] - ends[0])
    return (h ^ (h >> np.uint64(29))) * _MIX


def _pages_of(lang: str, sources: list[str], names: list[bytes], shard: np.ndarray, codes: np.ndarray, term: np.ndarray, n: np.ndarray,
              d: np.ndarray, run: int) -> Iterator[dict]:
    order = np.lexsort((codes, term, shard[term]))
    term, codes, n, d = term[order], codes[order], n[order], d[order]
    begins = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))  # of each term's postings
    ends, in_shard = np.append(begins[1:], len(term)), shard[term[begins]]
    first = 0
    while first < len(begins):
        same_shard = int(np.searchsorted(in_shard, in_shard[first], side="right"))
        last = min(same_shard, max(first + 1, int(np.searchsorted(begins, begins[first] + ENTRIES_PER_PAGE))))
        x, y = begins[first], ends[last - 1]
        own_terms = [names[k] for k in term[begins[first:last]].tolist()]
        yield {"shard": int(in_shard[first]), "lang": lang, "first": own_terms[0], "run": run, "terms": b" ".join(own_terms), "names": sources,
               "sizes": (ends[first:last] - begins[first:last]).astype(np.int32).tobytes(), "codes": codes[x:y].tobytes(),
               "counts": n[x:y].tobytes(), "docs": d[x:y].tobytes()}
        first = last


def spilled_runs(batches: Iterator[pd.DataFrame], shards: int, entries: int, size: int) -> Iterator[pd.DataFrame]:
    """The pages of all runs of a task's documents."""
    block, runs = Block(), 0
    texts: list[str] = []
    groups: list[int] = []
    chars = 0

    def spilled() -> Iterator[pd.DataFrame]:
        nonlocal block, runs
        pages = block.pages(shards, runs)
        while rows := list(islice(pages, 64)):
            yield pd.DataFrame(rows)
        block, runs = Block(), runs + 1

    for b in batches:
        for lang, source, text in zip(b["lang"], b["source"], b["text"]):
            group = block.group(lang, source)
            if len(text) > PIECE_CHARS:
                block.add_long(text, group)
            else:
                texts.append(text)
                groups.append(group)
                chars += len(text)
                if chars < min(SLAB_CHARS, size, 4 * entries):
                    continue
            if texts:
                block.add(texts, groups)
                texts, groups, chars = [], [], 0
            if block.entries >= entries or block.read >= size:
                yield from spilled()
    if texts:
        block.add(texts, groups)
    yield from spilled()


class _Open:
    """A page, from its next term on."""

    def __init__(self, row, code: dict[str, int]):
        self.terms = row.terms.split(b" ")
        self.ends = np.concatenate([[0], np.cumsum(np.frombuffer(row.sizes, np.int32))])
        self.codes = np.array([code.setdefault(s, len(code)) for s in row.names], np.int64)[np.frombuffer(row.codes, np.int32)]
        self.counts, self.docs = np.frombuffer(row.counts, np.int64), np.frombuffer(row.docs, np.int64)
        self.at = 0

    def __len__(self) -> int:
        return int(self.ends[-1] - self.ends[self.at])

    def take(self, until: bytes | None) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The terms below ``until`` (None: all), the number of postings of each, the postings."""
        stop = len(self.terms) if until is None else bisect_left(self.terms, until, self.at)
        x, y = self.ends[self.at], self.ends[stop]
        out = self.terms[self.at:stop], np.diff(self.ends[self.at:stop + 1]), self.codes[x:y], self.counts[x:y], self.docs[x:y]
        self.at = stop
        return out


def merged_runs(batches: Iterator[pd.DataFrame], min_docs: int, held_entries: int = 300_000) -> Iterator[pd.DataFrame]:
    """Frequencies of a shard: a row for each kept term and source, with the term's
    number ``t`` and its count in the whole language. Pages are opened until
    ``held_entries`` postings are; all terms below the next page's first are then
    merged by a heap over the open pages."""
    opened: list[_Open] = []
    names: dict[str, int] = {}
    lang = shard = None
    held = made = 0

    def merge(until: bytes | None) -> Iterator[pd.DataFrame]:
        nonlocal opened, held, made
        taken = [x for x in (page.take(until) for page in opened) if x[0]]
        opened = [page for page in opened if page.at < len(page.terms)]
        held = sum(map(len, opened))
        if not taken:
            return
        terms = [t for t, _ in groupby(heapq.merge(*(x[0] for x in taken)))]
        number = dict(zip(terms, range(len(terms))))
        place = np.concatenate([np.repeat(np.fromiter(map(number.__getitem__, x[0]), np.int64, len(x[0])), x[1]) for x in taken])
        codes, n, d = (np.concatenate([x[k] for x in taken]) for k in (2, 3, 4))
        order = np.lexsort((codes, place))
        place, codes, n, d = place[order], codes[order], n[order], d[order]
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (codes[1:] != codes[:-1])]))
        place, codes, n, d = place[new], codes[new], np.add.reduceat(n, new), np.add.reduceat(d, new)
        term_starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        in_lang, in_docs = np.add.reduceat(n, term_starts), np.add.reduceat(d, term_starts)
        keep = in_docs[place] >= min_docs
        place, codes, n = place[keep], codes[keep], n[keep]
        if not len(place):
            return
        known, text = list(names), [t.decode("utf-8", "surrogatepass") for t in terms]
        yield pd.DataFrame({"lang": [lang] * len(place), "term": [text[p] for p in place], "source": [known[c] for c in codes],
                            "t": (shard << 40) + made + place, "n": n, "n_lang": in_lang[place],
                            "first": np.concatenate([[True], place[1:] != place[:-1]])})
        made += len(terms)

    for b in batches:
        for row in b.itertuples(index=False):
            if row.lang != lang:
                yield from merge(None)
                lang, shard = row.lang, int(row.shard)
                names.clear()
            elif held >= held_entries:
                yield from merge(row.first)
            opened.append(_Open(row, names))
            held += len(opened[-1])
    yield from merge(None)


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / total), without overflow: by three digits of
    base 1000 (totals below 9e15; count + 1 is at most total)."""
    rest = np.asarray(count, np.int64) + 1
    total = np.asarray(total, np.int64)
    whole, rest = rest // total, rest % total
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // total, rest % total
    return whole + 1


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def pair_corrections(batches: Iterator[pd.DataFrame], rows_at_once: int = 100_000, pairs_at_once: int = 1 << 20) -> Iterator[pd.DataFrame]:
    """For terms that both sources of a pair have, what the sum of the pair needs
    beside the parts that look at one source's count (the other's being 0). Rows
    come in order of ``t``, the term; ``g`` numbers the groups, ``p0`` is the share
    of a count of 0. Sums are returned as text: they may not fit a long."""
    sums: dict[tuple[int, int], int] = defaultdict(int)

    def flushed() -> Iterator[pd.DataFrame]:
        items = list(sums.items())
        sums.clear()
        for at in range(0, len(items), 100_000):
            part = items[at:at + 100_000]
            yield pd.DataFrame({"g": [k[0] for k, _ in part], "h": [k[1] for k, _ in part], "value": [str(v) for _, v in part]})

    def add(pair: np.ndarray, value: np.ndarray, ids: np.ndarray) -> None:
        """Add up the values of equal pairs (first * len(ids) + second). Halves of the
        values are summed, so that sums of a million stay exact."""
        high, low = value >> 32, value & 0xFFFFFFFF
        if len(ids) ** 2 <= 4 * len(pair):
            at = np.flatnonzero(np.bincount(pair, minlength=len(ids) ** 2))
            sums_of = [np.bincount(pair, x, len(ids) ** 2)[at] for x in (high, low)]
        else:
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            new = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            at = pair[new]
            sums_of = [np.add.reduceat(x[order], new) for x in (high, low)]
        for k, hi, lo in zip(at.tolist(), *(x.tolist() for x in sums_of)):
            sums[int(ids[k // len(ids)]), int(ids[k % len(ids)])] += (int(hi) << 32) + int(lo)

    def whole_terms(rows: pd.DataFrame) -> None:
        t, g, p, p0 = (rows[c].to_numpy(np.int64) for c in ("t", "g", "p", "p0"))
        size = np.diff(np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1], [True]])))
        left = np.repeat(np.cumsum(size), size) - np.arange(len(t)) - 1  # rows after it in its term
        ids, code = np.unique(g, return_inverse=True)
        for step in range(1, int(size.max())):
            rows_at = np.flatnonzero(left >= step)
            for at in range(0, len(rows_at), pairs_at_once):
                x = rows_at[at:at + pairs_at_once]
                y = x + step
                both, x_only, y_only = (p[x] - p[y]) ** 2, (p[x] - p0[y]) ** 2, (p0[x] - p[y]) ** 2
                none = (p0[x] - p0[y]) ** 2
                add(code[x] * len(ids) + code[y], both // p[y] - x_only // p0[y] - y_only // p[y] + none // p0[y], ids)
                add(code[y] * len(ids) + code[x], both // p[x] - y_only // p0[x] - x_only // p[x] + none // p0[x], ids)

    held: list[pd.DataFrame] = []
    n = 0
    for b in batches:
        if not len(b):
            continue
        held.append(b)
        n += len(b)
        if n < rows_at_once:
            continue
        rows = pd.concat(held, ignore_index=True)
        open_from = int(np.searchsorted(rows["t"].to_numpy(), rows["t"].iloc[-1]))
        if open_from:
            whole_terms(rows.iloc[:open_from])
        held, n = [rows.iloc[open_from:]], len(rows) - open_from
        if len(sums) > 1_000_000:
            yield from flushed()
    if held:
        whole_terms(pd.concat(held, ignore_index=True))
    yield from flushed()


def term_frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, entries: int = ENTRIES_IN_MEMORY, size: int = BYTES_IN_MEMORY) -> DataFrame:
    """(lang, term, source, t, n, n_lang, first): occurrences of each term that is in
    at least ``min_docs`` documents of the language, in the source and in the
    language; ``t`` numbers the terms, ``first`` marks one row of each. Stored."""
    spark = docs.sparkSession
    ship(spark)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pages = docs.mapInPandas(lambda b: spilled_runs(b, shards, entries, size),
                             "shard int, lang string, first binary, run int, terms binary, names array<string>, sizes binary, codes binary, "
                             "counts binary, docs binary")
    merged = (pages.repartitionById(shards, F.col("shard")).sortWithinPartitions("lang", "first")
              .mapInPandas(lambda b: merged_runs(b, min_docs), "lang string, term string, source string, t long, n long, n_lang long, first boolean"))
    return stored(merged, "divergence-frequencies")


def _share(n: Column, total: Column) -> Column:
    """``share`` as a column."""
    count = (n.cast("decimal(20,0)") + F.lit(1).cast("decimal(20,0)")).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * count, total.cast("decimal(20,0)")).cast("long")


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def source_divergence(df: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, text_col: str = "text",
                      lang_col: str = "lang", source_col: str = "source", **spill) -> DataFrame:
    """For each (lang, source) of ``df``: its divergence from every other source of
    the language (part ``pair``) and the terms that it has more of than the language
    (part ``term``, at most ``top_terms``): lang, source, part, item, value, rank.

    A source's share of a kept term is 1 + floor(1e9 * (n + 1) / (N + V)): n its
    occurrences, N those of all kept terms, V their number in the language. The
    value of a term is floor((p - q)^2 / q), p the source's share; for part
    ``pair`` q is the other source's and the values of all kept terms are summed,
    for part ``term`` q is the language's. Ranks go by value, then by item.

    Null text, lang and source are read as ''. A group without kept terms takes
    part in pairs (0 where its language keeps none) and has no terms. Repeated rows
    are documents of their own. Other columns are not read; an empty table gives no
    rows. A value beyond a long is an error.
    """
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
                       for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    freq = term_frequencies(docs, min_docs, **spill)
    of_lang = freq.groupBy("lang").agg(F.sum("n").alias("n_lang_all"), F.count_if("first").alias("v"))
    of_group = freq.groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    zero = F.lit(0).cast("long")
    groups = (docs.select("lang", "source").distinct().join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
              .select("lang", "source", F.coalesce("n_all", zero).alias("n_all"), F.coalesce("n_lang_all", zero).alias("n_lang_all"),
                      F.coalesce("v", zero).alias("v"), F.monotonically_increasing_id().alias("g")))
    groups = stored(groups, "divergence-groups")
    groups = groups.withColumn("p0", F.when(F.col("v") > 0, _share(zero, F.col("n_all") + F.col("v"))).otherwise(F.lit(1).cast("long")))

    shared = stored(freq.join(groups, ["lang", "source"])
                    .withColumn("p", _share(F.col("n"), F.col("n_all") + F.col("v")))
                    .withColumn("q", _share(F.col("n_lang"), F.col("n_lang_all") + F.col("v")))
                    .select("lang", "source", "term", "t", "g", "p0", "p", "q"), "divergence-shares")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (shared.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                          _excess(F.col("p"), F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms))

    # the sums over one source's terms, by its distinct shares
    g, h = (groups.select("lang", F.col("source").alias(f"{x}_source"), F.col("g").alias(x), F.col("p0").alias(f"{x}0"), "v") for x in "gh")
    pairs = g.join(h.drop("v"), "lang").where("g <> h")
    big = "decimal(38,0)"
    alike = shared.groupBy("lang", "g", "p0", "p").agg(F.count(F.lit(1)).cast(big).alias("m"))
    both = alike.join(groups.select("lang", F.col("g").alias("other"), F.col("p0").alias("other0")), "lang").where("g <> other")
    m, p, p0, o0 = (F.col(c) for c in ("m", "p", "p0", "other0"))
    one_sided = F.explode(F.array(
        F.struct(F.col("g").alias("g"), F.col("other").alias("h"), (m * (_excess(p, o0) - _excess(p0, o0)).cast(big)).alias("value")),
        F.struct(F.col("other").alias("g"), F.col("g").alias("h"), (m * (_excess(o0, p) - _excess(o0, p0)).cast(big)).alias("value"))))
    single = both.select(one_sided.alias("x")).select("x.g", "x.h", F.col("x.value").cast(big).alias("value"))
    corrections = (shared.select("t", "g", "p", "p0").repartition("t").sortWithinPartitions("t", "g")
                   .mapInPandas(pair_corrections, "g long, h long, value string").withColumn("value", F.col("value").cast(big)))
    added = single.unionByName(corrections).groupBy("g", "h").agg(F.sum("value").cast(big).alias("added"))
    total = F.col("v").cast(big) * _excess(F.col("g0"), F.col("h0")).cast(big) + F.coalesce("added", F.lit(0).cast(big))
    sums = (pairs.join(added, ["g", "h"], "left")
            .select("lang", F.col("g_source").alias("source"), F.lit("pair").alias("part"), F.col("h_source").alias("item"),
                    total.cast("long").alias("value"))
            .withColumn("rank", F.row_number().over(by_value)))
    return sums.unionByName(terms)
