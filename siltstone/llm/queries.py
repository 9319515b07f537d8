"""The queries opN_<name>: each applies its operator with production parameters to the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.quality import quality_rules

    judged = quality_rules(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.decontaminate import decontaminate

    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.lines import line_dedup

    cut = line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"), "text")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.licenses import scan_licenses

    found = scan_licenses(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.warc import read_records, write_archives

    records = read_records(write_archives(read(spark, sf_dir, "pages")), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.urls import filter_urls

    return filter_urls(read(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.mixing import mix

    mixed = mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", *[F.round(F.get("positions", F.lit(i)), 9).alias(f"{nth}_position") for i, nth in enumerate(("first", "second"))])


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.neardup import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"), k=4, percent=80)


#: Key of the pseudonyms in the query; a deployment passes a secret one.
DEMO_KEY = b"not a secret"


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.pii import pseudonymise

    new = pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), DEMO_KEY)
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["kind"]))), ",")
    return new.select("doc_id", "n_found", kinds.alias("kinds"), "text")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siltstone.llm.toxicity import toxicity

    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries of this subpackage by name."""
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f) and name[2].isdigit()}
