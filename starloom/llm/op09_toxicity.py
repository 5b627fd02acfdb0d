"""Toxicity by weak supervision.

1. Voters. The lexicon is every word and word beginning that the training rows'
   documents use unevenly (log-likelihood ratio, counted in Spark, beyond what
   chance gives among so many terms). The strongest are voters of their own, the
   others are pooled by strength; pattern voters look at how many lexicon hits a text has, how dense they are, and at
   shouting. Each votes +1 (toxic), -1 (clean) or 0 (abstains). The given label
   of a training row is one more voter, with an accuracy of its own.
2. Generative label model. Votes given the hidden class are modelled by a mean
   per class and one shared covariance: the means are the voters' accuracies,
   the covariance their correlations, so that ten voters that always agree count
   about once. Fitted by expectation-maximisation.
3. A linear (logistic) classifier over lexicon counts and patterns is trained on
   the posterior labels and scores every text.

Terms are counted over all labelled training rows. The label model and the
classifier are fitted on about ``FIT_ROWS`` of them (chosen by a hash of the id),
which bounds the fit matrices. Scoring is one narrow pass.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_udf_of, code_points, id_bucket, ship, stored

#: Most labelled rows (about) that the label model and the classifier are fitted on.
FIT_ROWS = 20_000
#: Terms that are voters of their own; the rest of the lexicon, however long, is pooled
#: in so many voters.
VOTERS, POOLS = 256, 8
REJECT_AT = 0.7
HELD_OUT_MOD, HELD_OUT_REST = 3, 1

#: Lengths of word beginnings, in characters.
_PREFIXES = (4, 5, 6, 7)
#: Scripts that put no blanks between words: every two neighbours are a word.
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]{3,}")
_TABLE = bytes(32 if (b < 48 or 57 < b < 65 or 90 < b < 97 or 122 < b < 128) else b for b in range(256))
_PATTERNS = 5
#: Words whose voters are remembered, and terms that are counted before they are sent on.
_MEMO, _COUNTED = 50_000, 150_000
_UPPER: list[np.ndarray] = []


def capitals(text: str) -> int:
    """How many characters of the whole text are upper case."""
    if not _UPPER:
        _UPPER.append(np.fromiter((chr(c).isupper() for c in range(0x110000)), bool, 0x110000))
    return int(np.count_nonzero(_UPPER[0][code_points([text])[0]]))


def words_of(text: str) -> list[bytes]:
    text = text.lower()
    if not text.isascii():
        text = _UNSPACED.sub(lambda m: " ".join(map("".join, zip(m[0], m[0][1:]))).join("  "), text)
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def _terms_of(word: bytes) -> list[bytes]:
    """The word (marked by a closing space) and its beginnings, by characters."""
    if word.isascii():
        return [word + b" ", *(word[:k] for k in _PREFIXES if len(word) >= k)]
    letters = word.decode("utf-8", "surrogatepass")
    return [word + b" ", *(letters[:k].encode("utf-8", "surrogatepass") for k in _PREFIXES if len(letters) >= k)]


class Terms:
    """Counts the lexicon's terms (strongest first) in a text, by voter."""

    def __init__(self, terms: list[bytes], voters: int = VOTERS, pools: int = POOLS):
        rest = max(1, len(terms) - voters)
        self.at = {t: i if i < voters else voters + (i - voters) * pools // rest for i, t in enumerate(terms)}
        self.heads = {t.strip()[:4] for t in terms}
        self.n = len(terms) if len(terms) <= voters else voters + pools
        self.seen: dict[bytes, tuple[int, ...]] = {}  # the voters of words met before

    def voters_of(self, word: bytes) -> tuple[int, ...]:
        own = self.seen.get(word)
        if own is None:
            if len(self.seen) >= _MEMO:
                self.seen.clear()
            own = self.seen[word] = tuple(self.at[t] for t in _terms_of(word) if t in self.at)
        return own

    def features(self, text: str | None) -> np.ndarray:
        """log(1 + count) per voter, then the patterns: hit words, their share,
        share of capitals, of ! and of other marks."""
        text = text or ""
        out = np.zeros(self.n + _PATTERNS, np.float32)
        words = words_of(text)
        heads, hits = self.heads, 0
        counts: dict[int, int] = {}
        for w in words:
            if w[:4] in heads and (own := self.voters_of(w)):
                hits += 1
                for at in own:
                    counts[at] = counts.get(at, 0) + 1
        out[list(counts)] = list(counts.values())
        np.log1p(out, out=out)
        size = max(1, len(text))
        out[self.n:] = (np.log1p(hits), min(1.0, 10 * hits / max(1, len(words))),
                        capitals(text) / size, text.count("!") / size * 10,
                        sum(map(text.count, "#$%&*@")) / size * 10)
        return out


def votes_of(x: np.ndarray, n_terms: int) -> np.ndarray:
    """Votes of every voter for feature rows ``x``."""
    hits, share = np.expm1(x[:, n_terms]), x[:, n_terms + 1]
    lexicon = (x[:, :n_terms] > 0).astype(np.float64)
    patterns = [np.where(hits >= 3, 1, np.where(hits == 0, -1, 0)), np.where(share > 0.3, 1, np.where(share < 0.02, -1, 0)),
                np.where(x[:, n_terms + 2] > 0.5, 1, 0), np.where(x[:, n_terms + 3] > 0.1, 1, 0)]
    return np.column_stack([lexicon, *patterns])


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Posterior of class 1 for each row of ``votes`` (n x voters), by EM over
    class means and a shared covariance; ``given`` (0/1) is the label voter."""
    v = np.column_stack([votes, 2.0 * given - 1])
    post = 0.05 + 0.9 * given.astype(float)
    products = v.T @ v
    for _ in range(rounds):
        n1, n0 = post.sum(), (1 - post).sum()
        m1, m0 = post @ v / n1, (1 - post) @ v / n0
        cov = (products - n1 * np.outer(m1, m1) - n0 * np.outer(m0, m0)) / len(v)
        cov[np.diag_indices_from(cov)] += 0.05  # voters that never disagree stay invertible
        w = np.linalg.solve(cov, m1 - m0)
        z = v @ w - w @ (m1 + m0) / 2 + np.log(n1 / n0)
        new = np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.01, 0.99)
        if np.abs(new - post).max() < 1e-4:
            break
        post = new
    return new


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights (last: intercept) of a ridge logistic regression on soft targets,
    by iteratively reweighted least squares."""
    a = np.column_stack([x, np.ones(len(x))]).astype(np.float64)
    w = np.zeros(a.shape[1])
    penalty = np.full(a.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        s = np.maximum(p * (1 - p), 1e-4)
        step = np.linalg.solve((a * s[:, None]).T @ a + np.diag(penalty), a.T @ (target - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-5:
            break
    return w


@dataclass(frozen=True)
class ToxicityModel:
    terms: tuple[bytes, ...]
    weights: tuple[float, ...]

    def scores(self, texts, counter: Terms | None = None) -> np.ndarray:
        counter = counter or Terms(list(self.terms))
        w = np.array(self.weights)
        x = np.array([counter.features(t) for t in texts], np.float64).reshape(-1, len(w) - 1)
        return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def _term_counts(rows: DataFrame) -> DataFrame:
    """(term, n1, n0): documents of each class that use it, summed in each task
    before the shuffle. The empty term counts all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = (Counter(), Counter())

        def frame() -> pd.DataFrame:
            terms = list({*both[0], *both[1]})
            out = pd.DataFrame({"term": terms, "n1": [both[1][t] for t in terms], "n0": [both[0][t] for t in terms]})
            both[0].clear()
            both[1].clear()
            return out

        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"]):
                both[int(toxic)].update({b"", *(t for w in set(words_of(text or "")) for t in _terms_of(w))})
                if len(both[0]) + len(both[1]) > _COUNTED:
                    yield frame()
        if both[0] or both[1]:
            yield frame()

    return (rows.mapInPandas(count, "term binary, n1 long, n0 long").groupBy("term")
            .agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")))


def _lexicon(counts: DataFrame, all1: int, all0: int) -> list[bytes]:
    """The terms that lean to class 1, strongest first: by log-likelihood ratio, if
    it is above the logarithm of the number of terms (by chance, less than one term
    would be)."""
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")

    def part(k: Column, n: int) -> Column:
        rate = (n1 + n0) / F.lit(float(all1 + all0))
        some = F.when(k > 0, k * F.log(k / (n * rate))).otherwise(0.0)
        return some + F.when(n - k > 0, (n - k) * F.log((n - k) / (n * (1 - rate)))).otherwise(0.0)

    least = float(np.log(max(1, counts.count())))
    leaning = counts.where((n1 + n0 < all1 + all0) & (n1 / all1 > 2 * n0 / all0) & (F.length("term") > 0))
    found = leaning.withColumn("ratio", part(n1, all1) + part(n0, all0)).where(F.col("ratio") > least)
    return [bytes(r["term"]) for r in found.orderBy(F.desc("ratio"), "term").select("term").collect()]  # the lexicon, a part of every model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", fit_rows: int = FIT_ROWS, held_out: Column | None = None) -> ToxicityModel:
    """Fit on labelled rows that are not ``held_out`` (a Boolean over the labels).

    Null labels and ids do not take part; of several labels of a document the
    greatest counts. Without rows of both classes the model scores every text
    by the share of class 1 (0 if there are no rows).
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    if held_out is not None:
        known = known.where(~held_out)
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ship(docs.sparkSession)
    # a merge at every size: if few labels were broadcast and many not, a small run would say nothing of a large one
    counts = stored(_term_counts(texts.join(known.hint("merge"), "id").select("text", "toxic")), "terms")
    n1, n0 = next(((r["n1"], r["n0"]) for r in counts.where(F.length("term") == 0).collect()), (0, 0))
    share = float(n1 > 0 and not n0)
    flat = ToxicityModel((), (0.0,) * _PATTERNS + (float(np.log((share + 1e-3) / (1 - share + 1e-3))),))
    if not (n1 and n0):
        return flat
    terms = _lexicon(counts, n1, n0)
    total = known.count()
    if total > fit_rows:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * fit_rows / total))
    # about fit_rows narrow rows: a bounded broadcast, which spares a shuffle of the texts
    sample = texts.join(F.broadcast(known), "id").select("text", "toxic")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Terms(terms)
        for b in batches:
            yield pd.DataFrame({"x": [counter.features(t).tobytes() for t in b["text"]], "toxic": b["toxic"]})

    got = sample.mapInPandas(rows, "x binary, toxic int").collect()  # about fit_rows rows
    if not got:  # hardly any of very many labels has a document
        return flat
    got.sort(key=lambda r: (bytes(r["x"]), r["toxic"]))  # the sums below do not depend on the tasks' order
    given = np.array([r["toxic"] for r in got])
    x = np.frombuffer(b"".join([bytes(r["x"]) for r in got]), np.float32).reshape(len(got), -1)
    del got
    post = label_model(votes_of(x, x.shape[1] - _PATTERNS), given)
    return ToxicityModel(tuple(terms), tuple(logistic(x, post)))


def toxicity(text: Column, model: ToxicityModel) -> Column:
    """Score of ``text`` from 0 to 1; null counts as empty."""

    def rows(texts: pd.Series) -> pd.Series:
        counter = Terms(list(model.terms))
        return pd.Series(np.concatenate([model.scores(texts[a:a + 1000], counter) for a in range(0, max(1, len(texts)), 1000)]))

    return arrow_udf_of(rows, "double")(text)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    reject_at: float = REJECT_AT, **how) -> DataFrame:
    """One row per row of ``docs``: the id, ``held_out``, ``score``, ``predicted``.

    Training takes only ids whose crc32 modulo 3 is not 1. Empty and null texts
    get the score of a text without words; repeated rows are scored alike. Whole
    texts are counted, however long. Other columns, whatever their names, are not
    read; without labelled rows of both classes all texts score alike, and an empty
    table of documents gives an empty result.
    """
    held = F.coalesce(id_bucket(id_col, HELD_OUT_MOD) == HELD_OUT_REST, F.lit(False))
    model = fit(docs, labels, id_col, text_col, held_out=held, **how)
    return docs.select(F.col(id_col).alias(id_col), held.alias("held_out"),
                       toxicity(F.col(text_col), model).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= reject_at, 1).otherwise(0))
