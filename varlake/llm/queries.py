"""The numbered queries over the given tables, thin digests of the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varlake.llm import bpe, chat, decontaminate, fingerprint, jaccard, lines, markup, repair, substrings, topk, toxicity, vafile, warc
from varlake.llm.common import table
from varlake.llm.oracles import ORACLE_SQL  # noqa: F401


def _tokenizer() -> tuple[str, str]:
    """Path of the rank file and the pattern of its pieces."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are."""
    return fingerprint.edits(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, encoded and decoded again."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), *_tokenizer(), ["doc_id"])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of every document: lines, removed lines, digest of the text that stays."""
    kept = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), n=4, threshold=(85, 100)).select("doc_id", "n_shingles", "component_id")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the windows of 20 words that start earlier, too."""
    kept = substrings.dedup_substrings(table(spark, sf_dir, "documents"), n=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings, formatted; the digests are read back from the output."""
    own = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat.digests(chat.format_conversations(rows))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return markup.extract(pages, markup.fit(pages), ["page_id", "url"]).select("page_id", "url", "text", "n_chars")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from rows whose crc32(doc_id) is no multiple of 5,
    with the nearest examples. A null doc_id counts as held out."""
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    model = toxicity.fit(documents, table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity.score(documents, model, ["doc_id"], evidence=3)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.array_join(F.col("evidence.doc_id").cast("array<string>"), ",").alias("evidence"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back through their index."""
    index = warc.write_warc(table(spark, sf_dir, "pages"), revisit_bytes=0)
    return warc.read_warc(index, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark, with the items and the longest overlap."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"), "n_overlaps", "longest")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged: its faults, the cheapest edits and a digest of what they leave."""
    repairs, turns = repair.repair(table(spark, sf_dir, "conversations"))
    digests = repair.digests(turns).withColumnRenamed("conv_id", "id")
    found = repairs.join(digests, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", digest)


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest inner products of every embedding whose id is divisible by 50 with all other embeddings."""
    embeddings = table(spark, sf_dir, "embeddings")
    return topk.top_k(embeddings.where("vec_id % 50 = 0"), embeddings, k=5, scale=256)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in 16 clusters after three rounds, with distances and inertia."""
    assigned, centroids, _ = vafile.cluster(table(spark, sf_dir, "embeddings"), count=16, rounds=3, size=64, scale=64)
    return vafile.with_inertia(assigned, centroids)


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_bpe": op2_bpe,
    "op3_line_dedup": op3_line_dedup,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_chat_format": op6_chat_format,
    "op7_html_text": op7_html_text,
    "op8_toxicity": op8_toxicity,
    "op9_warc": op9_warc,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_topk_search": op12_topk_search,
    "op13_centroid_clustering": op13_centroid_clustering,
}
