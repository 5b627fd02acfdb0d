"""Every character in several contexts against the tokenizer libraries, and the
slowest texts of every secret rule."""

import base64
import time
import unicodedata

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import op02_chat, op05_secrets, op07_simhash, op08_packing
from starloom.llm.op03_bpe import encode
from starloom.llm.op06_token_counts import token_counts

EVERY = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]


def contexts(chars):
    return "".join(f"ab{c}cd !{c}! {c} 1{c}2 {c}{c}'{c}s  {c}\n" for c in map(chr, chars))


def texts_of(chars, n=128):
    return [contexts(chars[i:i + n]) for i in range(0, len(chars), n)]


@pytest.fixture(scope="module")
def table(spark):
    """Characters known to Python's tables together, the others in short texts."""
    known = [c for c in EVERY if unicodedata.category(chr(c)) != "Cn"]
    rest = [c for c in EVERY if unicodedata.category(chr(c)) == "Cn"]
    texts = texts_of(known) + texts_of(rest[::16] + [0x1C89, 0xA7CB, 0x558], 4)
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(16).cache()


def test_packing_takes_every_character_as_the_library_does(table):
    texts, df = table
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    got: dict = {}
    for r in df.transform(op08_packing.pack).sort("doc_id", "start").collect():
        got.setdefault(r.doc_id, []).extend(r.ids)
    assert [i for i, ids in enumerate(want) if got[i] != ids + [1]] == []


def test_token_counts_take_every_character_as_the_library_does(table):
    texts, df = table
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lib.no_truncation()
    got = {r.doc_id: r.n_tokens for r in token_counts(df).collect()}
    assert [i for i, e in enumerate(lib.encode_batch(texts, add_special_tokens=False)) if got[i] != len(e.ids)] == []


def test_byte_bpe_takes_every_character_as_the_library_does(table):
    texts, df = table
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: list(r.ids) for r in encode(df).select("doc_id", "ids").collect()}
    assert [i for i, t in enumerate(texts) if got[i] != lib.encode_ordinary(t)] == []


WORST = ["eyJ" * 350_000 + " .eyJ.eyJ", "eyJ" + "a" * 10**6, "eyJaaaaaaaa.eyJ" * 70_000, "eyJabcdefgh." * 80_000, "eyJ." * 250_000,
         "secret" + " " * 10**6, "token " * 160_000, "password=" * 110_000, "AKIA" * 250_000, "akia" * 250_000, "a" * 31 + "g" + "0" * 10**6,
         ("0" * 31 + "z") * 31_000, "ghp_" * 250_000, "xoxb-" * 200_000, "AIza" * 250_000, "sk_live_" * 120_000,
         "-----BEGIN PRIVATE KEY-----" * 37_000, "-----BEGIN PRIVATE KEY-----\n" + "A" * 10**6, "-----BEGIN PRIVATE KEY-----\n" + "a-" * 500_000,
         "-----BEGIN PRIVATE KEY-----\n" + "a: b\n" * 200_000, "-----BEGIN PRIVATE KEY-----" + "\\n" * 500_000, "-----BEGIN PRIVATE KEY-----\n" + "ab/" * 330_000 + "?",
         ("-----BEGIN PRIVATE KEY-----\n" + "A" * 60 + "\n") * 11_000]


@pytest.mark.parametrize("rule", op05_secrets.RULES, ids=lambda r: r.kind)
def test_secret_rules_are_linear(rule):
    scanner = op05_secrets.Scanner((rule,))
    scanner.scan(["warm up"])
    for text in WORST:
        t = time.process_time()
        scanner.scan([text])
        assert time.process_time() - t < 1, (rule.kind, text[:40])


def test_jwt_spans():
    scanner = op05_secrets.Scanner(tuple(r for r in op05_secrets.RULES if r.kind == "jwt"))
    one = "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJ_-SM"
    for before, after in (("", ""), ("token=", " x"), ("Bearer ", "."), ("ab_", ";"), ("eyJ.", ""), (one[:9] + ".", "")):
        (found,) = scanner.scan([before + one + after])
        assert [(s, e) for s, _, e in found] == [(len(before), len(before) + len(one))]
    assert [(s, e) for s, _, e in scanner.scan(["eyJ" + one])[0]] == [(0, 3 + len(one))]
    assert scanner.scan(["eyJshort.eyJzdWIiOiIx.SflKxwRJ"]) == [[]] and len(scanner.scan([f"{one} {one}\n{one}"])[0]) == 3


def test_one_row_of_each_component_stays(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(5, a, 1), (3, b, 2), (5, b, 3), (7, a, 4), (7, a, 4), (2, "other " * 3 + "words", 5), (2, "other " * 3 + "words", 5),
            (9, "same id " * 9, 6), (9, "same id " * 9, 7), (None, a, 8), (None, a, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_hash long").repartition(3)
    got = sorted(map(tuple, op07_simhash.keep_one_each(df).collect()), key=str)
    assert (9, "same id " * 9, 6) in got or (9, "same id " * 9, 7) in got
    assert sorted((r[0] or 0, r[2]) for r in got if r[0] != 9) == [(0, 8), (0, 8), (2, 5), (3, 2), (5, 1)] and len(got) == 6


def test_loss_spans_cut_the_trained_texts(spark):
    long = "x<&>" * 5000
    rows = [(1, i, "assistant" if i % 3 else "user", f"text {i} <&> &amp;\n" * (i % 4)) for i in range(1000)]
    rows += [(2, 0, "user", "no answer"), (3, 0, "assistant", long), (3, 1, "assistant", None), (3, 2, "a<b\nc", "z"), (3, 3, "assistant", "😀é" + long),
             (4, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    out = op02_chat.format_conversations(df).withColumn("loss", op02_chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()
    for r in out:
        want = [t or "" for i, _, role, t in rows if i == r.conv_id and role == "assistant"]
        escaped = [t.replace("&", "&amp;").replace("<", "&lt;") for t in want]
        assert [r.formatted[s.start:s.end] for s in r.loss_spans] == escaped and r.loss == "".join(want)
    assert len(out) == 4


def test_odd_characters_are_few_and_unassigned():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        odd = op08_packing.odd_characters(f.read())
    assert not odd[:0x378].any() and odd[0x378] and np.flatnonzero(~odd).size > 250_000
