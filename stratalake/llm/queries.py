"""The corpus operators as queries over the test tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.llm import byte_bpe, chat_format, secret_scan, token_counts
from stratalake.llm.common import source
from stratalake.llm.decontaminate import find_leaks
from stratalake.llm.hard_negatives import hard_negatives
from stratalake.llm.near_dedup import similar_documents
from stratalake.llm.quality_rules import judge_quality
from stratalake.llm.simhash import linked_documents
from stratalake.llm.substring_dedup import remove_repeats
from stratalake.llm.toxicity import score_toxicity, train_toxicity
from stratalake.llm.url_filter import UrlRule, filter_urls, split_url
from stratalake.llm.whitening import whiten
from stratalake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that gives the same rows if there is any."""

    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return add


def vocabulary() -> byte_bpe.Vocabulary:
    return byte_bpe.Vocabulary.read(
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query()
def op1_near_dedup(spark, sf_dir):
    return similar_documents(source(spark, sf_dir, "documents"))


URL_RULES = (
    UrlRule("block", "net/"),
    UrlRule("allow", "example.net/en/"),
    UrlRule("block", "example.com/de/"),
    UrlRule("allow", "org/fr/"),
)


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, bad): a page is bad if its document, whose number ends the path of the url, is
    labelled as of low quality."""
    _, path = split_url(F.col("url"))
    number = F.regexp_extract(path, r"/([0-9]+)(\.[A-Za-z0-9]+)?/*$", 1)
    numbered = pages.select("page_id", number.try_cast("long").alias("doc_id"))
    return numbered.join(labels.select("doc_id", (F.col("quality") == 0).alias("bad")), "doc_id").select("page_id", "bad")


@query()
def op2_url_filter(spark, sf_dir):
    pages = source(spark, sf_dir, "pages")
    return filter_urls(pages, page_labels(pages, source(spark, sf_dir, "labels")), URL_RULES)


@query()
def op3_secret_scan(spark, sf_dir):
    versions = source(spark, sf_dir, "documents").withColumn("version", F.lit(1))
    found = secret_scan.scan_history(versions, scratch_path(spark, "ledger"), path="doc_id")
    of_kind = lambda kind: F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")
    base = [rule.kind for rule in secret_scan.BASE]
    return found.select(
        F.col("path").alias("doc_id"),
        *(of_kind(kind).alias(f"n_{kind}") for kind in base),
        F.sha2(secret_scan.joined_spans(F.filter("findings", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
        secret_scan.joined_spans(F.col("findings")).alias("spans"),
    )


@query()
def op4_toxicity(spark, sf_dir):
    documents = source(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    net = train_toxicity(documents, source(spark, sf_dir, "labels").where(~held_out))
    return score_toxicity(documents, net).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op5_token_counts(spark, sf_dir):
    documents = source(spark, sf_dir, "documents").select("doc_id", "text")
    edits = token_counts.redactions(documents)
    return token_counts.recount_edited(documents, edits, vocabulary()).select(
        "doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_chars_split"
    )


@query()
def op6_substring_dedup(spark, sf_dir):
    return remove_repeats(source(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query()
def op7_decontaminate(spark, sf_dir):
    return find_leaks(source(spark, sf_dir, "documents"), source(spark, sf_dir, "benchmark"))


@query(
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    sized AS (
        SELECT *, 14 + length(role) + length(text)
                + length(role || text) - length(replace(replace(role || text, '\', ''), '<', ''))
                + length(role) - length(replace(role, chr(10), '')) AS size,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS back
        FROM turns),
    summed AS (
        SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY back DESC ROWS UNBOUNDED PRECEDING) AS upto
        FROM sized)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY back DESC)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY back DESC) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(upto) FILTER (role = 'assistant' OR back = 1) AS BIGINT) AS formatted_chars
    FROM summed GROUP BY conv_id"""
)
def op8_chat_format(spark, sf_dir):
    # A conversation that says what the template says.
    text = r"\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(text).alias("text"),
    )
    conversations = source(spark, sf_dir, "conversations").select(more.columns).unionByName(more)
    back = chat_format.read_back(chat_format.expand_replies(conversations))
    said = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    trained = F.array_join("trained", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query()
def op9_quality_rules(spark, sf_dir):
    judged = judge_quality(source(spark, sf_dir, "documents"), source(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


@query()
def op10_byte_bpe(spark, sf_dir):
    words = vocabulary()
    encoded = byte_bpe.encode(source(spark, sf_dir, "documents").select("doc_id", "text"), words)
    return byte_bpe.decode(encoded.drop("text"), words).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        byte_bpe.digest_of_ids(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op11_whitening(spark, sf_dir):
    return whiten(source(spark, sf_dir, "embeddings"))


@query()
def op12_simhash(spark, sf_dir):
    return linked_documents(source(spark, sf_dir, "documents"))


@query(
    """
    WITH given AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
               CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
        FROM given a JOIN given b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT p.anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
           other_id AS negative_id, positive_score, score AS negative_score
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3"""
)
def op13_hard_negatives(spark, sf_dir):
    return hard_negatives(source(spark, sf_dir, "embeddings"))
