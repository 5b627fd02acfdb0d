"""Quality rules by repetition coverage.

Words of a text become 64-bit values; rolling hashes give every word n-gram of
several lengths a value (``H_n[i] = H_{n-1}[i] * B + word[i+n-1]``), in numpy.
Windows whose value occurs again mark the words they span, and the share of
characters in marked words is the coverage of that length. Duplicate lines are
measured the same way. The work is one narrow pass: no shuffle, one text at a
time in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_udf_of

#: Most characters, as a share of all word characters, that repeated n-grams
#: (without each one's first occurrence) may cover.
COVERAGE_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Most characters that duplicate lines may hold. The share of duplicate lines
#: is measured but decides nothing: one of three lines is no defect.
MAX_DUP_LINE_CHARS = 0.20
BASE_WINDOW = 8
BASE_MIN_WORDS = 20
BASE_REPEAT_PERCENT = 30

_B = np.uint64(0x9E3779B97F4A7C15)
_SPACES = (9, 10, 11, 12, 13, 32)
_SYMBOLS = tuple(b"#*$%&|<>")


def _spread(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the ``n`` words inside any window [s, s + width)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:n]) > 0


def measure(text: str | None, lengths: tuple[int, ...]) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_lines, dup_line_chars,
    n_repeat_words, coverage of each length)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    word_chars = int(count[:0x80].sum() + count[0xC0:].sum() - count[list(_SPACES)].sum())
    n_symbols = int(count[list(_SYMBOLS)].sum())
    words = raw.split()
    n = len(words)

    seen: set[bytes] = set()
    n_lines = n_dup = dup_chars = 0
    for line in raw.split(b"\n"):
        if line.strip():
            n_lines += 1
            if line in seen:
                n_dup += 1
                dup_chars += sum(len(w.decode("utf-8", "surrogatepass")) for w in line.split())
            else:
                seen.add(line)

    coverage, repeat_words = dict.fromkeys(lengths, 0.0), 0
    wanted = {*lengths, BASE_WINDOW}
    if n > min(wanted):
        ids = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
        sizes = None
        h = ids.copy()
        for width in range(2, max(wanted) + 1):
            if n < width:
                break
            h = h[:-1] * _B + ids[width - 1:]
            if width not in wanted:
                continue
            _, first, group, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            if len(first) == len(h):
                break  # no window of this length occurs twice, so no longer one does
            often = times[group] > 1
            if width == BASE_WINDOW:
                repeat_words = int(_spread(np.flatnonzero(often), width, n).sum())
            if width in coverage:
                often[first] = False
                if sizes is None:
                    sizes = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in words), np.int64, n)
                coverage[width] = float(sizes[_spread(np.flatnonzero(often), width, n)].sum() / max(1, word_chars))
    return n, word_chars, n_symbols, n_dup, n_lines, dup_chars, repeat_words, *coverage.values()


def quality(text: Column, coverage_limits: dict[int, float] | None = None,
            max_dup_line_chars: float = MAX_DUP_LINE_CHARS) -> Column:
    """Struct of the measures and verdicts of ``text``.

    A null or empty text has no words: all counts are 0 and the base rule
    (fewer than 20 words) fails it. Repeated rows are measured alike.
    """
    limits = dict(sorted((COVERAGE_LIMITS if coverage_limits is None else coverage_limits).items()))
    lengths = tuple(limits)
    kind = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, dup_line_chars long, "
            "n_repeat_words long, base_failed boolean, kept boolean, dup_line_share double, dup_line_char_share double"
            + "".join(f", coverage_{n} double" for n in lengths))
    names = [f.strip().split(" ")[0] for f in kind.split(",")]

    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for t in texts:
                n, chars, symbols, dup, lines, dup_chars, repeat, *cover = measure(t, lengths)
                failed = n < BASE_MIN_WORDS or 100 * repeat > BASE_REPEAT_PERCENT * n
                share, char_share = dup / max(1, lines), dup_chars / max(1, chars)
                good = (not failed and char_share <= max_dup_line_chars
                        and all(c <= limits[k] for k, c in zip(lengths, cover)))
                out.append((n, chars, symbols, dup, lines, dup_chars, repeat, failed, good, share, char_share, *cover))
            yield pd.DataFrame(out, columns=names)

    return arrow_udf_of(rows, T.StructType.fromDDL(kind))(text)


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per input row: the id, the measures, ``base_failed``, ``kept``.

    Only the two named columns are read, so further columns cannot clash.
    Empty input gives an empty result with the same columns.
    """
    return (df.select(F.col(id_col).alias(id_col), quality(F.col(text_col), **limits).alias("q"))
            .select(id_col, "q.*"))
