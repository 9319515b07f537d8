"""Gate, effective score and global top-N."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.scalars import blank_to_null, effective_score, number, size_text
from siltstone.operators.ledger import anti_filter, require_columns


def gate(df: DataFrame, least_relevance: float = 60, least_aesthetic: float = 60) -> DataFrame:
    """Both scores reach their bounds; missing scores and NaN fail."""
    return df.where((number(F.col("ae_relevance")) >= least_relevance) & (number(F.col("ae_aesthetic")) >= least_aesthetic))


def top_n(df: DataFrame, n: int, score: Column, tie: str) -> DataFrame:
    """The ``n`` best rows in order; ties by ``tie``, so reruns agree."""
    return df.withColumn("effective", score).orderBy(F.col("effective").desc(), F.col(tie).asc()).limit(n)


def quality_filter(ledger: DataFrame, n: int = 16_000, least_relevance: float = 60, least_aesthetic: float = 60) -> DataFrame:
    """Unflagged records that pass the gate, best effective score first."""
    require_columns(ledger, "image_id", "is_unsafe", "dupe_removed", "ae_relevance", "ae_aesthetic")
    passed = gate(anti_filter(ledger, "is_unsafe", "dupe_removed"), least_relevance, least_aesthetic)
    return top_n(passed, n, effective_score(F.col("ae_relevance").cast("double"), F.col("ae_aesthetic").cast("double")), "image_id")


def with_payload(df: DataFrame, files: DataFrame, *paths: str) -> DataFrame:
    """Adds ``path``, the first of ``paths`` that the listing has, and ``status`` ok or missing.

    The existence test is one equi-join on the listing per path; rows are never dropped, and a missing payload is not
    replaced by the next best record.
    """
    out = df
    for i, p in enumerate(paths):
        listed = files.select(F.col("path").alias(f"_f{i}")).distinct()
        out = out.join(listed, blank_to_null(F.col(p)) == F.col(f"_f{i}"), "left")
    found = F.coalesce(*[F.col(f"_f{i}") for i in range(len(paths))])
    return out.withColumn("path", found).withColumn("status", F.when(found.isNull(), "missing").otherwise("ok")).drop(*[f"_f{i}" for i in range(len(paths))])


def base_table(df: DataFrame) -> DataFrame:
    """The projection that later stages read; ``phash64`` becomes ``phash``."""
    return df.select("path", "source_url", size_text(F.col("new_w"), F.col("new_h")).alias("image_size"), "ae_relevance", "ae_aesthetic", "image_id", F.col("phash64").alias("phash"))


def choose_source(ledger: DataFrame, files: DataFrame, root: str, inpainted: Column) -> DataFrame:
    """Adds ``source_used`` and ``source_path``: the painted file of flagged records if it exists, else the raw one."""
    from siltstone.functions.scalars import resolve, truthy

    listed = files.select("path").distinct()
    a, b = listed.withColumnRenamed("path", "_a"), listed.withColumnRenamed("path", "_b")
    raw = F.when(blank_to_null(F.col("path_raw")).isNotNull(), resolve(root, F.col("path_raw")))
    out = ledger.join(a, F.when(truthy(F.col("has_ocr")), inpainted) == F.col("_a"), "left").join(b, raw == F.col("_b"), "left")
    used = F.when(F.col("_a").isNotNull(), "inpainted").when(F.col("_b").isNotNull(), "raw")
    return out.withColumn("source_used", used).withColumn("source_path", F.coalesce("_a", "_b")).drop("_a", "_b")


def resize_plan(df: DataFrame, w: Column, h: Column, opened: Column | None = None, strict: bool = False) -> DataFrame:
    """Sizes, scale, kernel, aspect ratios and status of each record; nulls where nothing is resized."""
    from siltstone.functions.scalars import aspect, target_size, truthy

    t = F.col("_t")
    status = F.when(truthy(F.col("is_unsafe")), "skipped_nsfw").when(F.col("source_used").isNull(), "missing").when(~F.coalesce(opened if opened is not None else F.lit(True), F.lit(False)) | w.isNull() | h.isNull(), "error_open").otherwise("ok")
    out = df.withColumn("status", status).withColumn("_t", F.when(F.col("status") == "ok", target_size(w, h, strict)))
    ok = F.col("status") == "ok"
    return out.withColumns({
        "orig_w": F.when(ok, w), "orig_h": F.when(ok, h), "new_w": t["new_w"], "new_h": t["new_h"], "scale": F.bround(t["scale"], 6), "kernel": t["kernel"], "resize_action": t["action"],
        "ar_before": F.when(ok, aspect(w, h)), "ar_after": F.when(ok, aspect(t["new_w"], t["new_h"])), "status_msg": F.when(F.col("status") == "missing", "source not found").otherwise(""),
    }).drop("_t")
