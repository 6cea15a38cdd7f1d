"""The registered queries of this folder: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from isobar.llm import (
    chat, decontamination, langid, licenses, lm_scoring, merkle, packing, quality, sentencepieces, simhash, spelling,
    sql, syncmers, toxicity,
)
from isobar.llm.common import crc_mod, table

Query = Callable[[SparkSession, str], DataFrame]
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod("doc_id", 7) == 2
    scored = lm_scoring.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.withColumn("held_out", held_out)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare_with_next(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that match, with the window and its edits."""
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1, whose texts hold control strings."""
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    done = chat.format_conversations(turns.unionByName(extra)).withColumn("formatted", chat.formatted(F.col("segments")))
    read = done.withColumn("turns", chat.parsed(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("segments")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod("doc_id", 3) == 1
    scored = quality.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), teach=~held_out
    )
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Nothing else runs in these workers, so they may hold larger tables than those of a pipeline.
    pieces = packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), recent=(1_000_000, 200_000), slice_bytes=8 << 20
    )
    return pieces.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity, likeliest grade, chance of any toxicity and whether the text is rejected."""
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "toxicity.*")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files source/thousands/id."""
    path = F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000).cast("string"), F.col("doc_id").cast("string"))
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"), id_col="doc_id", path=path)
    return found.withColumn("cosine", F.round("cosine", 6))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod("doc_id", 4) == 2
    return langid.identify(table(spark, sf_dir, "documents"), ~held_out).withColumn("held_out", held_out)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document; one in five is tampered with before it is checked."""
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [F.translate("text", UPPER, LOWER) if n == "text" else F.col(n) for n in names]
    keep = {"tampered": F.when(crc_mod("doc_id", 5) == 0, merkle.leaf_hash(tampered))}
    found = merkle.manifest(table(spark, sf_dir, "documents"), fields=names, keep=keep)
    checked = found.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return checked.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"))
    return spelling.spelling_variants(words)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text that they decode to, as digests."""
    model = public_tokenizers.path(PIECE_BPE)
    done = sentencepieces.decode(sentencepieces.encode(table(spark, sf_dir, "documents"), model), model)
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_lm_scoring, op2_fingerprints, op3_decontamination, op4_chat_formatting, op5_quality, op6_packing,
        op7_toxicity, op8_license_scan, op9_simhash, op10_language_id, op11_merkle_manifest, op12_spelling_variants,
        op13_sentencepiece,
    )
}
_CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
placed AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS DISTINCT FROM role AS opens,
        length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS text_chars,
        length(replace(replace(role, '\', '\\'), '<|', '<\|')) AS role_chars
    FROM turns
),
whole AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
        -- A message opens with <|role|>, the role and <|body|> and closes with <|end|>; <|turn|> parts its texts.
        sum(text_chars + CASE WHEN opens THEN 8 + role_chars + 8 + 7 ELSE 8 END) AS formatted_chars
    FROM placed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
    CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM whole"""

SQL: dict[str, str] = {
    "op4_chat_formatting": _CHAT,
    "op11_merkle_manifest": sql.merkle(["doc_id", "source", "lang", "n_chars", "text"]),
    "op12_spelling_variants": sql.spelling(),
    "op8_license_scan": licenses.sql(
        "doc_id", "concat_ws('/', source, (doc_id // 1000)::VARCHAR, doc_id::VARCHAR)", "documents"
    ),
}
