"""The trained models against plain computations of the same."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from starloom.llm import op09_toxicity as T
from starloom.llm.op04_langid import REJECT_SHARE, identify_languages

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ language models
def kept_characters(text):
    out = []
    for c in text or "":
        if regex.fullmatch(r"\p{L}", c):
            out.append(c.lower()[0])
        elif out and out[-1] != " ":
            out.append(" ")
    return out


def plain_kneser_ney(rows):
    """(id, lang, text) of the counted rows -> function of a text: {lang: entropy per character}."""
    models = {}
    for lang in sorted({r[1] for r in rows if r[1] is not None}):
        top = Counter()
        for _, own, text in rows:
            if own == lang:
                chars = ["", "", "", *kept_characters(text)]
                top.update(tuple(chars[i:i + 4]) for i in range(len(chars) - 3))
        tables = [top]
        for _ in range(3):
            shorter = Counter()
            for g in tables[0]:
                shorter[g[1:]] += 1
            tables.insert(0, shorter)
        orders = []
        for t in tables:
            ones, twos = (sum(1 for n in t.values() if n == k) for k in (1, 2))
            total, kinds = Counter(), Counter()
            for g, n in t.items():
                total[g[:-1]] += n
                kinds[g[:-1]] += 1
            orders.append((t, min(0.95, ones / (ones + 2 * twos) if ones else 0.5), total, kinds))
        models[lang] = orders

    def p(orders, gram):
        if not gram:
            return 1 / 65536
        t, d, total, kinds = orders[len(gram) - 1]
        lower = p(orders, gram[1:])
        c = total[gram[:-1]]
        return (max(t[gram] - d, 0) + d * kinds[gram[:-1]] * lower) / c if c else lower

    def entropies(text):
        chars = ["", "", "", *kept_characters(text)]
        n = len(chars) - 3
        return {x: -sum(math.log(p(o, tuple(chars[i:i + 4]))) for i in range(n)) / n for x, o in models.items()} if any(c.strip() for c in chars) else {}

    return entropies


@pytest.mark.parametrize("how", [{}, {"max_cells": 1}])
def test_language_models_equal_plain_kneser_ney(spark, how):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", F.substring("text", 1, 300).alias("text"))
    rows = [tuple(r) for r in docs.collect()]
    crc = {i: zlib.crc32(str(i).encode()) for i, _, _ in rows}
    entropies = plain_kneser_ney([r for r in rows if crc[r[0]] % 4 != 2 and crc[r[0]] % 20 >= 4])
    for r in identify_languages(docs, **how).collect():
        want = entropies(next(t for i, _, t in rows if i == r.doc_id))
        assert r.held_out == (crc[r.doc_id] % 4 == 2) and r.lang_pred == (min(want, key=lambda x: (want[x], x)) if want else "und")
        if want:
            assert abs(r.entropy - want[r.lang_pred]) < 1e-4
            assert abs(r.score - 1 / sum(math.exp(16 * max(-40, want[r.lang_pred] - e)) for e in want.values())) < 1e-2


def test_letters_above_the_first_plane_are_told_apart(spark):
    rng = random.Random(0)

    def text(first, n):
        return " ".join("".join(chr(first + rng.randrange(n)) for _ in range(6)) for _ in range(30))

    rows = [(i, *rng.choice([("adlam", text(0x1E922, 34)), ("osage", text(0x104D8, 36)), ("han", text(0x20000, 500))])) for i in range(240)]
    got = identify_languages(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()
    assert all(r.lang_pred == rows[r.doc_id][1] for r in got)


def test_ties_go_to_the_first_language(spark):
    rows = [(i, "zz" if i % 2 else "aa", "the same text in both") for i in range(400)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 20 >= 4 and zlib.crc32(str(r[0]).encode()) % 4 != 2]
    n = min(sum(r[1] == x for r in rows) for x in ("aa", "zz"))
    even = [r for x in ("aa", "zz") for r in [r for r in rows if r[1] == x][:n]]
    assert {r.lang_pred for r in identify_languages(spark.createDataFrame(even, "doc_id long, lang string, text string")).collect()} == {"aa"}


def test_rejection_is_calibrated(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(2)
    noise = [(-i - 1, "".join(rng.choice("qxzjkwvyпдфжбю") + rng.choice("  qzx") for _ in range(200)), None) for i in range(100)]
    got = identify_languages(docs.unionByName(spark.createDataFrame(noise, docs.schema))).join(
        docs.select("doc_id", F.col("lang").alias("truth")), "doc_id", "left").toPandas()
    own = got[got.held_out & got.truth.notna() & (got.lang_pred != "und")]
    assert len(own) > 1000 and own.rejected.mean() < 4 * REJECT_SHARE
    assert got[got.doc_id < 0].rejected.mean() > 0.95


# ------------------------------------------------------------------ toxicity
def plain_terms(word):
    return [word + " ", *(word[:k] for k in (4, 5, 6, 7) if len(word) >= k)]


def plain_words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower())


def test_lexicon_and_scores_equal_plain_counts(spark):
    rng = random.Random(3)
    mild, bad = [f"word{chr(97 + i)}né" for i in range(20)], [f"vile{chr(97 + i)}sch" for i in range(12)] + ["ünflätig"]
    rows = [(i, " ".join(rng.choices(mild + (bad if i % 3 == 0 else bad[:1]), k=40)) + "!" * (i % 3 == 0) * 5, int(i % 3 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    model = T.fit(df, df)
    n1, n0 = Counter(), Counter()
    for _, text, toxic in rows:
        (n1 if toxic else n0).update({t for w in set(plain_words(text)) for t in plain_terms(w)})
    terms, all1, all0 = {*n1, *n0}, sum(r[2] for r in rows), sum(1 - r[2] for r in rows)

    def ratio(t):
        rate, out = (n1[t] + n0[t]) / (all1 + all0), 0.0
        for k, n in ((n1[t], all1), (n0[t], all0)):
            out += (k * math.log(k / (n * rate)) if k else 0) + ((n - k) * math.log((n - k) / (n * (1 - rate))) if n - k else 0)
        return out

    lean = {t: ratio(t) for t in terms if n1[t] + n0[t] < all1 + all0 and n1[t] / all1 > 2 * n0[t] / all0}
    want = sorted((t for t in lean if lean[t] > math.log(len(terms) + 1)), key=lambda t: (-round(lean[t], 9), t.encode()))
    assert sorted(t.decode() for t in model.terms) == sorted(want) and len(want) > 10
    order = {t.decode(): i for i, t in enumerate(model.terms)}
    texts = [r[1] for r in rows[:50]] + ["", "Nothing of it!", "VILEASCH vileb vileschen"]
    for text, got in zip(texts, model.scores(texts)):
        words, x = plain_words(text), np.zeros(len(order) + 5)
        for w in words:
            for t in plain_terms(w):
                if t in order:
                    x[order[t]] += 1
        hits, size = sum(any(t in order for t in plain_terms(w)) for w in words), max(1, len(text))
        x[:len(order)] = np.log1p(x[:len(order)])
        x[len(order):] = (math.log1p(hits), min(1, 10 * hits / max(1, len(words))), sum(map(str.isupper, text)) / size,
                          text.count("!") / size * 10, sum(map(text.count, "#$%&*@")) / size * 10)
        assert abs(got - 1 / (1 + math.exp(-(x @ np.array(model.weights[:-1]) + model.weights[-1])))) < 1e-4


def test_label_model_equals_dense_gaussians():
    """EM with explicit normal densities of a shared covariance."""
    rng = np.random.default_rng(4)
    y = (rng.random(1500) < 0.4).astype(int)
    votes = np.column_stack([np.where(rng.random(1500) < a, 2 * y - 1, rng.choice([-1, 0, 1], 1500)) for a in (0.5, 0.6, 0.8)]).astype(float)
    given = np.where(rng.random(1500) < 0.9, y, 1 - y)
    v = np.column_stack([votes, 2.0 * given - 1])
    post = 0.05 + 0.9 * given
    for _ in range(20):
        share = post.mean()
        means = [(w[:, None] * v).sum(axis=0) / w.sum() for w in (post, 1 - post)]
        cov = sum((w[:, None, None] * ((v - m)[:, :, None] * (v - m)[:, None, :])).sum(axis=0) for w, m in zip((post, 1 - post), means)) / len(v)
        cov += 0.05 * np.eye(v.shape[1])
        logs = [math.log(s) - 0.5 * np.einsum("ij,jk,ik->i", v - m, np.linalg.inv(cov), v - m) for s, m in zip((share, 1 - share), means)]
        new = np.clip(1 / (1 + np.exp(logs[1] - logs[0])), 0.01, 0.99)
        if np.abs(new - post).max() < 1e-4:
            break
        post = new
    assert np.abs(T.label_model(votes, given) - new).max() < 1e-6
    assert ((new > 0.5) == y).mean() > 0.85


def test_long_lexicons_are_pooled_not_cut():
    terms = [f"term{i:04d} ".encode() for i in range(1000)]
    counter = T.Terms(terms)
    assert counter.n == T.VOTERS + T.POOLS and {counter.at[t] for t in terms[T.VOTERS:]} == set(range(T.VOTERS, counter.n))
    x = counter.features("term0999 term0999 term0003 other")
    assert math.isclose(math.expm1(x[counter.n]), 3, rel_tol=1e-5) and math.isclose(math.expm1(x[counter.at[b"term0999 "]]), 2, rel_tol=1e-5)


def test_words_of_scripts_without_blanks():
    assert [w.decode() for w in T.words_of("我们要去北京 ok")] == ["我们", "们要", "要去", "去北", "北京", "ok"]
    assert [t.decode() for t in T._terms_of("größenwahn".encode())] == ["größenwahn ", "größ", "größe", "größen", "größenw"]
    assert T._terms_of("東京".encode()) == ["東京 ".encode()]
