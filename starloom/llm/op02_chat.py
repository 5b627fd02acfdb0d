"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted; adjacent turns of
one role merge into a block (array functions over the sorted turns); blocks are
concatenated into one text:

    <turn>ROLE\\nTEXT<next>TEXT</turn>\\n<turn>...

``&`` and ``<`` inside roles and texts are written ``&amp;`` and ``&lt;``, and a
role's line ends ``&#10;``, so the marks cannot occur in them and the reading
back is exact.

The loss mask is a list of spans of the formatted text, one for each text of
the trained role, without any marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, NEXT, CLOSE = "<turn>", "<next>", "</turn>\n"
TRAINED_ROLE = "assistant"


def escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(c: Column) -> Column:
    lines = F.replace(c, F.lit("&#10;"), F.lit("\n"))
    return F.replace(F.replace(lines, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def blocks(turns: Column) -> Column:
    """array<struct<role, texts>> of sorted turns, adjacent equal roles merged."""
    starts = F.filter(F.sequence(F.lit(1), F.size(turns)), lambda i: (i == 1) | (
        F.element_at(turns, i)["role"] != F.element_at(turns, F.greatest(i - 1, F.lit(1)))["role"]))
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.size(turns) + 1))
    return F.zip_with(starts, ends, lambda s, e: F.struct(
        F.element_at(turns, s)["role"].alias("role"),
        F.transform(F.slice(turns, s, e - s), lambda t: t["text"]).alias("texts")))


def formatted(merged: Column) -> Column:
    one = F.transform(merged, lambda b: F.concat(
        F.lit(OPEN), F.replace(escaped(b["role"]), F.lit("\n"), F.lit("&#10;")), F.lit("\n"),
        F.array_join(F.transform(b["texts"], escaped), NEXT), F.lit(CLOSE)))
    return F.array_join(one, "")


def read_back(text: Column) -> Column:
    """array<struct<role, text>> of a formatted text: the turns as they were."""
    raw = F.filter(F.split(text, CLOSE, -1), lambda b: F.startswith(b, F.lit(OPEN)))
    parts = F.transform(raw, lambda b: F.struct(
        F.substring_index(F.substr(b, F.lit(len(OPEN) + 1)), "\n", 1).alias("role"),
        b.alias("b")))
    turns = F.transform(parts, lambda p: F.transform(
        F.split(F.substr(p["b"], F.length(p["role"]) + len(OPEN) + 2), NEXT, -1),
        lambda t: F.struct(unescaped(p["role"]).alias("role"), unescaped(t).alias("text"))))
    return F.flatten(turns)


_CHUNK = 256


def _chunks(items: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _CHUNK).cast("int")),
                       lambda c: F.slice(items, c * _CHUNK + 1, _CHUNK))


def _sums_before(sizes: Column) -> Column:
    """For each of the (one or more) longs the sum of those before it. Arrays are
    grown a chunk at a time, so a long list is not copied for each of its items."""

    def grown(items: Column, first: Column) -> Column:
        return F.aggregate(items, F.array(first), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))

    zero = F.lit(0).cast("long")
    chunks = _chunks(sizes)
    starts = grown(F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, x: a + x)), zero)
    return F.flatten(F.zip_with(chunks, F.slice(starts, 1, F.size(chunks)), lambda c, s: F.slice(grown(c, s), 1, F.size(c))))


def loss_spans(merged: Column, role: str = TRAINED_ROLE) -> Column:
    """array<struct<start, end>> of ``formatted(merged)``, in code points, end
    exclusive: each text of the trained role, in order (its escaped form)."""
    def pieces(b: Column) -> Column:
        head = F.length(F.replace(escaped(b["role"]), F.lit("\n"), F.lit("&#10;"))) + len(OPEN) + 1
        return F.transform(b["texts"], lambda t, i: F.struct(
            (b["role"] == role).alias("trained"), F.when(i == 0, head).otherwise(len(NEXT)).cast("long").alias("lead"),
            F.length(escaped(t)).cast("long").alias("size"),
            F.when(i == F.size(b["texts"]) - 1, len(CLOSE)).otherwise(0).cast("long").alias("tail")))

    flat = F.flatten(F.transform(merged, pieces))
    before = _sums_before(F.transform(flat, lambda p: p["lead"] + p["size"] + p["tail"]))
    spans = F.zip_with(flat, before, lambda p, n: F.struct(
        p["trained"].alias("trained"), (n + p["lead"]).alias("start"), (n + p["lead"] + p["size"]).alias("end")))
    return F.transform(F.filter(spans, lambda s: s["trained"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def cut(text: Column, spans: Column) -> Column:
    """The parts of ``text`` that the (ordered) spans name; many spans go by way
    of the stretch that a chunk of them covers, so the text is not read from its
    beginning for each."""
    def chunk(c: Column) -> Column:
        first = F.get(c, F.lit(0))["start"]
        stretch = F.substring(text, (first + 1).cast("int"), (F.element_at(c, -1)["end"] - first).cast("int"))
        return F.transform(c, lambda s: F.substring(stretch, (s["start"] - first + 1).cast("int"), (s["end"] - s["start"]).cast("int")))

    return F.when(F.size(spans) == 0, F.array().cast("array<string>")).otherwise(F.flatten(F.transform(_chunks(spans), chunk)))


def format_conversations(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per conversation: the id, ``blocks``, the ``formatted`` text and its
    ``loss_spans`` (start and end, in code points, of each text of the trained role).

    Turns go by number, ties by role and text; repeated rows stay. A null text
    is empty, a null role the empty role, a null turn number comes first, and
    rows with a null id form one conversation. Further columns are not read.
    Empty input gives an empty result.
    """
    role = F.coalesce(F.col(role_col), F.lit(""))
    turn = F.struct(F.col(turn_col).alias("turn"), role.alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    turns = df.select(F.col(id_col).alias(id_col), turn.alias("t")).groupBy(id_col).agg(
        F.sort_array(F.collect_list("t")).alias("turns"))
    merged = turns.select(id_col, blocks(F.col("turns")).alias("blocks"))
    return merged.select(id_col, "blocks", formatted(F.col("blocks")).alias("formatted"),
                         loss_spans(F.col("blocks"), trained_role).alias("loss_spans"))


def loss_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(cut(text, spans), unescaped), "")
