"""Repetition coverage against plain counting."""

import random
import re
from collections import Counter

import pytest

from starloom.llm.op01_quality import BASE_WINDOW, COVERAGE_LIMITS, MAX_DUP_LINE_CHARS, measure, quality_rules


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    chars = sum(map(len, words))
    cover = {}
    for n in COVERAGE_LIMITS:
        windows = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        seen, marked = set(), set()
        for i, w in enumerate(windows):
            if w in seen:
                marked.update(range(i, i + n))
            seen.add(w)
        cover[n] = sum(len(words[i]) for i in marked) / max(1, chars)
    windows = [tuple(words[i:i + BASE_WINDOW]) for i in range(len(words) - BASE_WINDOW + 1)]
    times = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + BASE_WINDOW)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    again = [x for i, x in enumerate(lines) if x in lines[:i]]
    dup_chars = sum(len(w) for x in again for w in re.findall(r"[^\x20\x09-\x0D]+", x))
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    kept = not failed and dup_chars / max(1, chars) <= MAX_DUP_LINE_CHARS and all(cover[n] <= COVERAGE_LIMITS[n] for n in cover)
    return len(words), chars, len(again), dup_chars, len(repeated), cover, failed, kept


def texts():
    rng = random.Random(7)
    out = [None, "", "one", "a b " * 4, " ".join(map(str, range(200)))]
    for _ in range(300):
        vocabulary = [f"w{i}é" for i in range(rng.choice([3, 30, 3000]))]
        parts = [rng.choices(vocabulary, k=rng.randint(1, 40)) for _ in range(rng.randint(1, 12))]
        parts += [rng.choice(parts) for _ in range(rng.randint(0, 6))]
        out.append(rng.choice([" ", "\n", " \t"]).join(" ".join(p) + rng.choice(["", "\n", "  "]) for p in parts))
    return out


@pytest.mark.parametrize("part", range(4))
def test_measures_equal_plain_counting(part):
    for text in texts()[part::4]:
        n, chars, _, dup, _, dup_chars, repeat, *cover = measure(text, tuple(COVERAGE_LIMITS))
        want = plain(text)
        assert (n, chars, dup, dup_chars, repeat) == want[:5]
        assert cover == pytest.approx([want[5][k] for k in COVERAGE_LIMITS])


def test_verdicts_equal_plain_counting(spark):
    rows = list(enumerate(texts()))
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {i: plain(t)[6:] for i, t in rows}
    assert sum(k for _, k in got.values()) > 20 and sum(not f and not k for f, k in got.values()) > 10
