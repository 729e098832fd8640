"""The queries that apply the operators of this subpackage to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm import (decontaminate, license_scan, line_dedup, manifest, merkle, packing, quality, sharding,
                          simhash_dedup, suffix_dedup, tool_calls, url_filter, whitening)
from tablekit.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without their site's boilerplate lines; the source is the site."""
    out = line_dedup.drop_boilerplate_lines(table(spark, sf_dir, "documents"), report=("n_lines", "n_removed"))
    return out.select("doc_id", "source", "n_lines", "n_removed", F.col("text").alias("kept_text"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from labels that are not held out."""
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op3_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every call of every conversation, linked, ordered, validated, as canonical JSON."""
    return tool_calls.link_tool_calls(tool_calls.events_from_chat(table(spark, sf_dir, "conversations")), tool_calls.REPLY_SCHEMA)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces in sequences of at most 2048 tokens."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), 2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, 3 bits."""
    found = simhash_dedup.fingerprint_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprint of every document, its edit, and both likenesses."""
    return merkle.compare_neighbours(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) match, with its best window."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("start").alias("start_word"), "n_words", "similarity")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier."""
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), width=100)
    removed = F.aggregate(F.zip_with("ends", "starts", lambda b, a: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    return cut.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                      removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
                      F.sha2(F.col("kept"), 256).alias("kept_sha256"))


# The rules of the contract, and words that mark spam hosts.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
SPAM_HOST = r"(^|[.-])(spam|pills?|casinos?|viagra|porn|xxx|loans|bets?|betting)([.-]|$)"


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the rules, then against the canonical URLs of spam hosts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, verdict string")
    host = url_filter.url_host(F.col("url"))
    listed = pages.where(host.rlike(SPAM_HOST)).select(url_filter.canonical_url(F.col("url")).alias("canonical"))
    return url_filter.judge_urls(pages, rules, listed).select("page_id", "host", "path", "rule", "verdict")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template notices, wrapped or not, of every document."""
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"), wrapped=True)
    n = F.size("places")
    starts = F.transform("places", lambda p: p["at"])
    base = F.transform("places", lambda p: p["label"])
    join = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id", "n_words", n.cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        join(base).alias("base_labels"), join(F.concat(base, F.col("hits"))).alias("labels"),
        F.when(n > 0, 1.0).otherwise(F.col("containment")).alias("score"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of about equal bytes."""
    sharded = sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=24)
    return sharded.select("doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                          F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding on the first 16 whitened components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a leaf of the dataset's Merkle tree, with its proof checked."""
    found = manifest.verify_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_tool_call_linking": op3_tool_call_linking,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_merkle_fingerprints": op6_merkle_fingerprints,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_license_scan": op10_license_scan,
    "op11_sharding": op11_sharding,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_merkle_manifest": op13_merkle_manifest,
}
