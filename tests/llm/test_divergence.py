"""Source divergence against brute force, with edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from oracle_harness import compare, duck
from starloom.llm import op12_divergence as D
from starloom.llm import queries as Q
from starloom.plans.registry import ORACLE

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, term string, `VALUE` long, g long"


def terms_of(text):
    return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, min_docs=3, top=200):
    docs = [(lang or "", source or "", terms_of(text)) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        in_docs = Counter(t for _, _, ts in own for t in set(ts))
        kept = {t for t, n in in_docs.items() if n >= min_docs}
        counts = {s: Counter(t for _, s2, ts in own if s2 == s for t in ts if t in kept) for s in {d[1] for d in own}}
        whole = sum(counts.values(), Counter())

        def share(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        q_lang = share(whole)
        shares = {s: share(c) for s, c in counts.items()}
        for s, p in shares.items():
            pairs = [(sum((p[t] - q[t]) ** 2 // q[t] for t in kept), o) for o, q in shares.items() if o != s]
            terms = [((p[t] - q_lang[t]) ** 2 // q_lang[t], t) for t in kept if counts[s][t] and p[t] > q_lang[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                for r, (v, i) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode())), 1):
                    if part == "pair" or r <= top:
                        out.append((lang, s, part, i, v, r))
    return sorted(out)


def odd_documents():
    rng = random.Random(4)
    words = ["alpha", "Beta", "néé", "σίσυφος", "中文", "x1y", "it's", "don't", "😀", "ÀB", "zz", "q"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 60))), rng.choice(["en", "fr", None, ""]), rng.choice(["a", "b", "c", None])) for i in range(150)]
    rows += [(200, None, "en", "nothing"), (201, "", "de", "alone"), (202, "once only here", "it", "s1"), (203, "12 34 !", "it", "s2"), rows[0], rows[0],
             (None, "alpha Beta\x00gamma\x7fDELTA[x]y", None, "a"), (204, "alpha " * 20_000 + "Beta" * 5000, "en", "long"),
             (205, " ".join(rng.choices(words, k=30_000)), "fr", "c"), (206, " alpha beta\u0085", "en", "b")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("how", [{}, {"entries": 7, "size": 1 << 20}, {"entries": 10**6, "size": 500}])
def test_divergence_matches_brute_force(spark, how):
    rows = odd_documents()
    got = D.source_divergence(frame(spark, rows), **how)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_only_the_best_terms_are_returned(spark):
    rows = odd_documents()
    got = D.source_divergence(frame(spark, rows), min_docs=2, top_terms=3).collect()
    assert sorted(map(tuple, got)) == brute(rows, min_docs=2, top=3)
    assert D.source_divergence(frame(spark, rows).limit(0)).count() == 0


def test_terms_cross_no_piece():
    text = "Alpha beta " * 5 + "gamma" * 9 + " É1é x" + "😀" * 7
    for chars in (1, 2, 3, 7, 1000):
        got = [t.decode() for part in D.term_lists(text, chars) for t in part]
        assert got == terms_of(text)
    assert list(D.term_lists(None)) == [] and [t for p in D.term_lists(" 12 ") for t in p] == []


def test_runs_are_merged_in_bounded_pages(monkeypatch):
    """Runs of many pages, merged in the order that a shuffle sorts them into."""
    monkeypatch.setattr(D, "ENTRIES_PER_PAGE", 3)
    rng = random.Random(1)
    rows = pd.DataFrame([(rng.choice("ab"), rng.choice("xyz"), " ".join(rng.choices("abcdefghijklmnop", k=30))) for _ in range(60)],
                        columns=["lang", "source", "text"])
    pages = pd.concat(D.spilled_runs(iter([rows]), 1, 40, 1 << 30)).sort_values(["lang", "first"], kind="stable")
    assert pages["run"].nunique() > 10 and len(pages) > 100
    got = pd.concat(D.merged_runs(iter([pages.iloc[:50], pages.iloc[50:]]), 1, held_entries=20))
    want = Counter((lang, t, s) for lang, s, text in rows.itertuples(index=False) for t in text.split())
    assert {(r.lang, r.term, r.source): r.n for r in got.itertuples()} == dict(want) and len(got) == len(want)
    assert got["first"].sum() == len({k[:2] for k in want})


def test_shares_of_large_counts_are_exact():
    n, total = np.array([10**14, 0, 7 * 10**15, 8 * 10**15 - 1]), np.array([3 * 10**14, 9 * 10**15 - 1, 8 * 10**15, 8 * 10**15])
    assert D.share(n, total).tolist() == [1 + 10**9 * (int(a) + 1) // int(b) for a, b in zip(n, total)]


def test_query_equals_its_sql(spark):
    got = compare(spark, duck(SF), "op12", Q.op12_source_divergence, ORACLE["op12_source_divergence"], SF)
    assert got["status"] == "OK" and not got["type_mismatch"] and got["rows"] > 0, got
