"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table and derives the contract's digest
columns from the operator's result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans.registry import query

from .common import table
from .op01_quality import quality_rules
from .op02_chat import format_conversations, loss_text, read_back
from .op03_bpe import encode
from .op04_langid import identify_languages
from .op05_secrets import find_secrets, span_digest
from .op06_token_counts import token_counts
from .op07_simhash import simhash_components
from .op08_packing import pack
from .op09_toxicity import score_documents
from .op10_topk import top_inner_products
from .op11_negatives import hard_negatives
from .op12_divergence import source_divergence
from .op13_vector_dedup import near_duplicate_vectors

#: A conversation whose texts look like a template's own marks.
TRICKY = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


@query("op2_chat_format", sql="""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
    ), e AS (
        SELECT *, lag(role) OVER w IS DISTINCT FROM role OR lag(role) OVER w IS NULL AS opens,
               replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&#10;') AS er, replace(replace(text, '&', '&amp;'), '<', '&lt;') AS et
        FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
           CAST(sum(CASE WHEN opens THEN 6 + length(er) + 1 + 8 ELSE 6 END + length(et)) AS BIGINT) AS formatted_chars
    FROM e GROUP BY conv_id""")
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(TRICKY, rows.schema))
    back = format_conversations(rows).select("conv_id", "formatted", "loss_spans", read_back(F.col("formatted")).alias("turns"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"),
                       F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), digests=True)


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda x: x["base"])

    def n(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(span_digest(base).cast("binary"), 256).alias("base_sha256"),
                        span_digest(F.col("found")).alias("spans"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), keep_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_topk", sql="""
    WITH e AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
        FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
    ), r AS (
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
    )
    SELECT * FROM r WHERE rank <= 10""")
def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_inner_products(rows, rows.where(F.col("vec_id") % 100 == 0))


@query("op11_hard_negatives", sql="""
    WITH e AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
               CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
        FROM e a JOIN e c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
    ), p AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER w <= 5""")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


@query("op12_source_divergence", sql=r"""
    WITH d AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM documents
    ), kept AS (
        SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 3
    ), n AS (
        SELECT lang, source, term, count(*) AS c FROM (SELECT lang, source, unnest(terms) AS term FROM d) JOIN kept USING (lang, term) GROUP BY ALL
    ), v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang), groups AS (SELECT DISTINCT lang, source FROM d),
    counts AS (
        SELECT g.lang, g.source, k.term, coalesce(n.c, 0) AS c, v FROM groups g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source, term)
    ), shares AS (
        SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang, source) + v) AS p FROM counts
    ), lang_shares AS (
        SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang) + v) AS q
        FROM (SELECT lang, term, sum(c) AS c, any_value(v) AS v FROM counts GROUP BY ALL)
    ), pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
    ), terms AS (
        SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM shares JOIN lang_shares USING (lang, term) WHERE c > 0 AND p > q
    ), ranked AS (
        SELECT g.lang, g.source, 'pair' AS part, o.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
        FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = o.source
        UNION ALL SELECT lang, source, 'term', item, CAST(value AS BIGINT) FROM terms
    )
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM ranked
    QUALIFY part = 'pair' OR rank <= 200""")
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


@query("op13_vector_dedup")
def op13_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
