"""Secret scan over a trigram inverted index.

Each rule's regex is parsed into a Boolean trigram query: literal stretches
that any match must contain, as AND of trigrams, OR over alternatives. Every
block of texts gets an inverted index (trigram -> rows of the block, as a
bitmap) of the trigrams that any query names; the queries intersect and unite
postings, and only the candidate rows are verified by the regex. A rule without
a mandatory trigram scans all rows. The index lives with its block, like a
segment: no shuffle, memory bounded by the block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import product
from re import _parser as sre

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_udf_of, slabs


@dataclass(frozen=True)
class Rule:
    """``regex``; ``least`` characters of ``group`` at least; ``base``: counts
    toward the digest of the contract."""

    kind: str
    regex: str
    least: int = 0
    group: int = 0
    ignore_case: bool = False
    base: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.regex, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


#: What a key's body is made of besides base64: headers, and blanks, line ends
#: (also written out as \\n) and marks of quotes, comments and code.
_HEADER = r"[A-Za-z][A-Za-z0-9-]*+:(?:(?!-----)[^\r\n\\])*+"
_BETWEEN = r"""[\s\\"'>#*|,;()]"""
_LINE_END = r"""(?:\r?\n|\r|\\r|\\n)(?:[\x20\t"'>#*|,;()]|\\[rnt]|\r?\n|\+(?=\s))*+"""
#: A line that is base64 to its end; a long run of base64 after other text.
_BASE64_LINE = r"""[A-Za-z0-9+/=]++(?=[\x20\t"',;()+]*+(?:[\r\n\\]|-----|\Z))"""
_BASE64_RUN = r"[\x20\t]*+[A-Za-z0-9+/=]{40,}+(?:[\x20\t]++[A-Za-z0-9+/]++={1,2})?+"
#: From the BEGIN line to its END line; without one, to the last base64 line.
_PRIVATE_KEY = (rf"-----BEGIN ((?:[A-Z]+ )*)PRIVATE KEY-----(?:(?:{_HEADER}|[A-Za-z0-9+/=]++|{_BETWEEN})*+-----END \1PRIVATE KEY-----"
                rf"|(?:{_LINE_END}(?:{_HEADER}|{_BASE64_LINE})|{_BASE64_RUN})*+)")

RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         8, 2, ignore_case=True, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", 16, base=True),
    Rule("hex", r"[0-9a-f]+", 32, base=True),
    Rule("private_key", _PRIVATE_KEY),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{30,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    # a run that does not go on as a token matches with an empty group and is read past, not again from its next eyJ
    Rule("jwt", r"eyJ((?:[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+)?)[A-Za-z0-9_-]*+", 1, 1),
)

#: Alternatives of a literal stretch that are followed one by one; a class or
#: product above this is treated as "anything", which only adds candidates.
_WIDE = 64


def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _clause(stretch: set[str]) -> list[frozenset[str]]:
    """OR of trigram sets; [] says "always true"."""
    sets = [_grams(s) for s in stretch]
    if not sets or not all(sets):
        return []
    return [s for s in sets if not any(o < s for o in sets)]


def _exact(item) -> set[str] | None:
    """The strings that ``item`` matches (lower case), or None if many."""
    op, arg = item
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "AT":
        return {""}
    if name == "IN":
        got = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                got.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < _WIDE:
                got.update(chr(c).lower() for c in range(value[0], value[1] + 1))
            else:
                return None
        return got if len(got) <= 8 else None
    if name == "SUBPATTERN":
        return _exact_all(arg[-1])
    if name == "BRANCH":
        parts = [_exact_all(b) for b in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if name in ("MAX_REPEAT", "MIN_REPEAT") and (arg[0], arg[1]) in ((0, 1), (1, 1)):
        one = _exact_all(arg[2])
        return one and (one | {""} if arg[0] == 0 else one)
    return None


def _exact_all(items) -> set[str] | None:
    out = {""}
    for x in items:
        e = _exact(x)
        if e is None or len(out) * len(e) > _WIDE:
            return None
        out = {a + b for a, b in product(out, e)}
    return out


def _query(items) -> list[list[frozenset[str]]]:
    """AND of clauses; each clause an OR of trigram sets (all of one needed)."""
    out, stretch = [], {""}
    for x in items:
        e = _exact(x)
        if e is not None and len(stretch) * len(e) <= _WIDE:
            stretch = {a + b for a, b in product(stretch, e)}
            continue
        out.append(_clause(stretch))
        stretch = e if e is not None else {""}
        op, arg = str(x[0]), x[1]
        if op == "SUBPATTERN":
            out += _query(arg[-1])
        elif op in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
            out += _query(arg[2])
        elif op == "BRANCH" and e is None:
            parts = [_query(b) for b in arg[1]]
            if all(parts):  # the first clause of each alternative must hold in one of them
                out.append([s for p in parts for s in p[0]])
    out.append(_clause(stretch))
    return [c for c in out if c]


def trigram_query(rule: Rule) -> list[list[frozenset[str]]]:
    """The rule's Boolean query over lower-case trigrams ([]: scan fully).
    Only ASCII trigrams are used."""
    clauses = _query(sre.parse(rule.regex, re.ASCII))
    return [c for c in clauses if all(ord(ch) < 128 for s in c for g in s for ch in g)]


class BlockIndex:
    """Inverted index of the named trigrams over one block of texts."""

    def __init__(self, slots: np.ndarray, n_slots: int, texts: list[str]):
        raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        buf = np.frombuffer(b"".join(raws), np.uint8)
        buf = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint8)
        ends = np.cumsum([len(r) for r in raws])
        self.bits = np.zeros((n_slots, len(texts)), bool)
        if len(buf) >= 3:
            code = (buf[:-2].astype(np.int32) << 16) | (buf[1:-1].astype(np.int32) << 8) | buf[2:]
            slot = slots[code]
            at = np.flatnonzero(slot >= 0)
            row = np.searchsorted(ends, at, side="right")
            inside = at + 3 <= ends[row]  # not across two texts
            self.bits[slot[at[inside]], row[inside]] = True


class Scanner:
    """The rules, their queries, and the trigram slots they use."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.queries = [trigram_query(r) for r in rules]
        names = sorted({g for q in self.queries for c in q for s in c for g in s})
        self.slot_of = {g: i for i, g in enumerate(names)}
        self.slots = np.full(1 << 24, -1, np.int16)
        for g, i in self.slot_of.items():
            a, b, c = g.encode("ascii")
            self.slots[(a << 16) | (b << 8) | c] = i
        self.patterns = [r.compiled() for r in rules]
        # the same matches, found faster: a whole-match minimum on a one-class run
        self.scans = [re.compile(r.regex[:-1] + f"{{{r.least},}}", re.ASCII)
                      if r.least and not r.group and re.fullmatch(r"\[[^\]]+\]\+", r.regex) else None for r in rules]

    def candidates(self, index: BlockIndex, query: list, n: int) -> np.ndarray:
        hit = np.ones(n, bool)
        for clause in query:
            any_of = np.zeros(n, bool)
            for grams in clause:
                any_of |= index.bits[[self.slot_of[g] for g in grams]].all(axis=0)
            hit &= any_of
        return np.flatnonzero(hit)

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, rule number, end), in that order."""
        found: list[list] = [[] for _ in texts]
        index = BlockIndex(self.slots, len(self.slot_of), texts)
        for k, (rule, query) in enumerate(zip(self.rules, self.queries)):
            pattern = self.scans[k] or self.patterns[k]
            for i in self.candidates(index, query, len(texts)):
                for m in pattern.finditer(texts[i]):
                    if len(m[rule.group]) >= rule.least:
                        found[i].append((m.start(), k, m.end()))
        for x in found:
            x.sort()
        return found


_SCANNERS: dict[tuple[Rule, ...], Scanner] = {}


def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    if rules not in _SCANNERS:
        _SCANNERS[rules] = Scanner(rules)
    return _SCANNERS[rules]


def secrets(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """array<struct<kind, start, end, base>> of ``text``: code points, end
    exclusive, by start and then by the order of the rules. Null: empty text.
    Kinds are matched leftmost and non-overlapping, each on its own; spans of
    different kinds may overlap."""

    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = _scanner(rules)
        for texts in batches:
            out = []
            for block in slabs(texts):
                out += [[{"kind": rules[k].kind, "start": s, "end": e, "base": rules[k].base} for s, k, e in one]
                        for one in scanner.scan(block)]
            yield pd.Series(out, dtype=object)

    kind = "array<struct<kind:string,start:long,end:long,base:boolean>>"
    return arrow_udf_of(rows, kind)(text)


def redacted(text: Column, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> Column:
    """``text`` with every found span (overlapping ones joined) replaced by
    ``mark``; null stays null, a text without finds stays as it is."""

    def rows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = _scanner(rules)
        for texts in batches:
            out, given = [], iter(texts)
            for block in slabs(texts):
                for t, spans in zip(block, scanner.scan(block)):
                    parts, at = [], 0
                    for s, _, e in spans:
                        if s >= at or not parts:
                            parts += [t[at:s], mark]
                        at = max(at, e)
                    out.append(None if next(given) is None else "".join([*parts, t[at:]]))
            yield pd.Series(out, dtype=object)

    return arrow_udf_of(rows, "string")(text)


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: the id and its ``found`` spans (may be empty).
    Other columns are not read. Empty input gives an empty result."""
    return df.select(F.col(id_col).alias(id_col), secrets(F.col(text_col), rules).alias("found"))


def span_digest(found: Column) -> Column:
    """'kind:start:end' joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest_of(spans: list[tuple[str, int, int]]) -> str:
    return sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
