"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.decontaminate import decontaminate, excise
from siltstone.llm.lines import line_dedup
from siltstone.llm.mixing import mix
from siltstone.llm.neardup import near_duplicates
from siltstone.llm.quality import quality_rules
from siltstone.storage import Scratch, delete, materialize, scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Intermediate tables of the stage that ran last; they go when the next one begins.
_tables = Scratch()
#: SQL can express neither the label model nor the hashed order of the mix; tests/llm compares with brute force.
ORACLE_SQL = None


def _begin(spark: SparkSession) -> Scratch:
    _tables.close(spark)
    return _tables


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts are too short and go; rows that repeat are judged alike; an empty table stays empty; all but
    the columns of ``documents`` are left behind, so extra ones may have any name.
    """
    with _begin(spark):
        return quality_rules(docs).where("kept").select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated lines go; so do documents of which nothing else is left.

    Null and empty texts stay as they are; rows with the same id and text are one document and are cut alike, null ids
    come last in order; an empty table stays empty; extra columns are left behind.
    """
    with _begin(spark):
        cut = line_dedup(docs.select(*COLUMNS))
        left = cut.where((F.col("n_removed") == 0) | (F.col("text") != "") | F.col("text").isNull())
        n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        return left.select("doc_id", "text", "lang", "source", n_chars.cast("long").alias("n_chars"))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id.

    Of rows that repeat an id one stays, the one with the greatest text (nulls last).  Null and empty texts are like
    nothing and stay; rows with a null id are linked with nothing, but of those with one text one stays; an empty table
    stays empty; extra columns are left behind.
    """
    with _begin(spark):
        gone = materialize(near_duplicates(docs).where("NOT kept").select("doc_id").distinct(), "gone")
        left = docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")
        # The text's hash tells null ids apart, and which row of an id stays is one combined maximum.
        key = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
        rest = [c for c in COLUMNS if c != "doc_id"]
        one = left.select("doc_id", key.alias("_key"), F.struct(*[F.col(c).alias(f"_{c}") for c in rest]).alias("_row"))
        counted = left.groupBy("doc_id", key.alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        repeated = materialize(counted.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k")), "repeated")
        match = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_key").eqNullSafe(F.col("_k"))
        single = one.join(repeated, match, "left_anti").select("doc_id", "_row")
        chosen = one.join(repeated, match, "left_semi").groupBy("doc_id", "_key").agg(F.max("_row").alias("_row")).select("doc_id", "_row")
        return single.unionByName(chosen).select("doc_id", *[F.col(f"_row._{c}").alias(c) for c in rest])


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; where a document holds a passage of a single item, only that passage goes.

    Null and empty texts hold nothing and stay; rows that repeat are judged alike; empty tables of documents or items
    change nothing; extra columns are left behind.
    """
    with _begin(spark):
        found = decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("NOT contaminated")
        return excise(found).select("doc_id", "text", "lang", "source", F.when(F.size("spans") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training schedule: how many words of each document the mix takes, and where they stand.

    Null and empty texts have size 0 and are not taken; rows that repeat are separate documents; null sources are one
    source; an empty table gives an empty schedule; extra columns are left behind.
    """
    with _begin(spark):
        return mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", filter_quality),
    ("line dedup", dedup_lines),
    ("near dedup", dedup_near),
    ("decontamination", remove_benchmarks),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again, and goes when the next is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{i}", released=i == len(STAGES) - 1)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        _tables.close(spark)
        if before is not None:
            delete(spark, before)
        before = path
    return docs
