"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import (
    bagminhash,
    bitplane_files,
    bm25_packing,
    charpoly_whitening,
    chunk_dedup,
    cover_negatives,
    disclosure,
    prefix_chat,
    prefix_forest,
    qda_quality,
    source_mix,
    url_filter,
    wrappers,
)
from roadlens.llm.common import table

WORD_BPE = "word_bpe_49k.json"
WORD_BPE_SIZE = 49_408
BYTE_BPE = "byte_bpe_50k.json"


def op1_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bm25_packing.pack_documents(docs, public_tokenizers.path(WORD_BPE), end_id=1, vocabulary=WORD_BPE_SIZE)


def op3_bitplane(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bitplane_files.read_token_files(bitplane_files.write_token_files(docs, public_tokenizers.path(BYTE_BPE), end_id=0))


def op4_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bagminhash.near_duplicates(docs).select("doc_id", "class_id", "class_size", "kept")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = qda_quality.described(docs)
    scores = qda_quality.scored(stats, qda_quality.train(stats, table(spark, sf_dir, "labels")))
    predicted = F.when(F.col("score") >= qda_quality.KEEP_AT, 1).otherwise(0)
    return scores.select("doc_id", qda_quality.held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.fit(url_filter.default_labels(spark)))


def op7_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunk_dedup.duplicate_groups(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = disclosure.sanitise_spans(docs)
    counts = [disclosure.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")]
    return rows.select(
        "doc_id", *counts,
        F.sha2(disclosure.joined(F.col("base")), 256).alias("base_sha256"),
        disclosure.joined(F.col("spans")).alias("spans"),
    )


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = source_mix.copies_per_document(docs, source_mix.mix_rates(docs))
    return out.select(
        "doc_id",
        source_mix.word_count().alias("size"),
        F.col("__mix_source_size").alias("source_size"),
        F.col("__mix_target").alias("target"),
        (source_mix.word_count() * F.col("__mix_copies")).alias("taken"),
        F.col("__mix_copies").alias("copies"),
    )


def op10_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return prefix_forest.search(vectors, F.col("vec_id") % 50 == 0)


def op11_charpoly(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    white = charpoly_whitening.whiten(vectors)
    # where an exact deviation exceeds a long, the column is null
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return cover_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, moved)


def op13_prefix_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ok = "</s>[INST] ok [/INST]"
    told = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ok).alias("text")
    )
    return prefix_chat.digests(prefix_chat.format_conversations(turns.unionByName(told)))


SPARK = {
    "op1_wrappers": op1_wrappers,
    "op2_packing": op2_packing,
    "op3_bitplane": op3_bitplane,
    "op4_bagminhash": op4_bagminhash,
    "op5_quality": op5_quality,
    "op6_urls": op6_urls,
    "op7_chunk_dedup": op7_chunk_dedup,
    "op8_disclosure": op8_disclosure,
    "op9_mix": op9_mix,
    "op10_forest": op10_forest,
    "op11_charpoly": op11_charpoly,
    "op12_cover_tree": op12_cover_tree,
    "op13_prefix_chat": op13_prefix_chat,
}

SQL = {
    "op7_chunk_dedup": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
    """,
    "op12_cover_tree": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
    "op13_prefix_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ),
        e AS (
            SELECT *, regexp_replace(replace(role, '\', '\\'), c, '\1\\\2', 'g') AS r, regexp_replace(replace(text, '\', '\\'), c, '\1\\\2', 'g') AS x
            FROM t, (SELECT '(<|\[)(\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|</SYS>>|INST\]|/INST\])' AS c)
        ),
        s AS (SELECT *, '<|im_start|>' || r || '<|im_sep|>' || x || '<|im_end|>' AS segment FROM e),
        p AS (
            SELECT *, sum(length(segment)) OVER w AS stop, row_number() OVER w AS nth, count(*) OVER (PARTITION BY conv_id) AS n
            FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, segment ROWS UNBOUNDED PRECEDING)
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
               (sum(stop) FILTER (role = 'assistant' OR nth = n))::BIGINT AS formatted_chars
        FROM p GROUP BY conv_id
    """,
}
