"""Stage plans over a ledger with ``row_id``: each returns the updated ledger and what it logs or writes.

Only rows that a stage still has to do are worked on (``overwrite`` redoes all), payloads join by path on their way
into the worker, and results are written once before the ledger is updated by key.  With ``dry_run`` a plan returns
the rows that it would work on, and changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import rasters
from siltstone.functions.documents import parse_caption, parse_scores
from siltstone.functions.scalars import blank_to_null, is_blank, output_extension, truthy
from siltstone.operators import ledger as led
from siltstone.operators import media, rank
from siltstone.operators.detect import Detect, detect_boxes
from siltstone.sinks.payloads import write_files
from siltstone.storage import materialize


def _by_row(ledger: DataFrame, results: DataFrame, columns: list[str]) -> DataFrame:
    """The ledger with new values of ``columns`` where a row has a result."""
    new = results.select(F.col("row_id").alias("_r"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = ledger.join(new, F.col("row_id") == F.col("_r"), "left")
    found = F.col("_r").isNotNull()
    return joined.select(
        *[F.when(found, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in ledger.columns],
        *[F.col(f"_new_{c}").alias(c) for c in columns if c not in ledger.columns],
    )


def score(ledger: DataFrame, payloads: DataFrame, build: Callable, path: str = "path_resized", tries: int = 3, overwrite: bool = False, dry_run: bool = False) -> DataFrame:
    """Relevance and aesthetic scores of unflagged rows; a reply that does not parse leaves the row as it was."""
    known = led.ensure_columns(ledger, ae_relevance="int", ae_aesthetic="int")
    todo = led.pending(led.anti_filter(known, "is_unsafe"), "ae_relevance", overwrite).where(~is_blank(F.col(path)))
    if dry_run:
        return led.preview(todo, 20, "row_id")
    asked = todo.select("row_id", "image_id", F.col(path).alias("path")).join(payloads, "path")
    replied = materialize(media.apply_model(asked, build, ["image_id", "content"], "reply string", tries).select("row_id", parse_scores(F.col("reply")).alias("x")).where("x IS NOT NULL"), "scores")
    return _by_row(known, replied.select("row_id", F.col("x.relevance").alias("ae_relevance"), F.col("x.aesthetic").alias("ae_aesthetic")), ["ae_relevance", "ae_aesthetic"])


def phash(ledger: DataFrame, payloads: DataFrame, decoder: rasters.Decoder | None = None, overwrite: bool = False, dry_run: bool = False) -> DataFrame:
    """``phash64`` as 16 hexadecimal digits; rows without a file or with one that does not decode keep what they had."""
    known = led.ensure_columns(ledger, phash64="string", out_path="string", path_resized="string")
    todo = led.pending(known, "phash64", overwrite).withColumn("path", media.hash_source(known)).where(~is_blank(F.col("path")))
    if dry_run:
        return led.preview(todo, 20, "row_id")
    hashed = todo.select("row_id", "path").join(payloads, "path").select("row_id", media.perceptual_hash(decoder)(F.col("content")).alias("h")).where("h IS NOT NULL")
    return _by_row(known, materialize(hashed.select("row_id", F.lower(F.lpad(F.hex("h"), 16, "0")).alias("phash64")), "phash"), ["phash64"])


def flag_unsafe(ledger: DataFrame, payloads: DataFrame, build: Callable, run: str, threshold: float = 0.5, tags: tuple[str, ...] = led.UNSAFE_TAGS, overwrite: bool = False, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """(ledger with ``is_unsafe`` and its score and tags, audit rows of this run); ``build`` makes image -> {tag: score}."""
    columns = ["is_unsafe_score", "is_unsafe_tags", "is_unsafe"]
    known = led.ensure_columns(ledger, is_unsafe="boolean", is_unsafe_score="double", is_unsafe_tags="string")
    todo = led.pending(known, "is_unsafe_score", overwrite).where(~is_blank(F.col("path_raw")))
    if dry_run:
        return led.preview(todo, 20, "row_id"), todo.limit(0)
    asked = todo.select("row_id", F.col("path_raw").alias("path")).join(payloads, "path")
    told = media.apply_model(asked, build, ["content"], "scores map<string, double>").where("status = 'ok'")
    flagged = materialize(led.flag_by_score(told, "scores", threshold, tags).select("row_id", *columns), "unsafe")
    out = _by_row(known.withColumn("is_unsafe", truthy(F.col("is_unsafe"))), flagged, columns)
    new = out.join(flagged.where("is_unsafe").select("row_id"), "row_id", "left_semi")
    audit = new.withColumns({"nsfw_tags": F.col("is_unsafe_tags"), "nsfw_score": F.format_string("%.3f", "is_unsafe_score"), "threshold": F.lit(str(threshold))})
    return out, led.drop_log(audit, "is_unsafe", "nsfw", "score", run)


def unflag_unsafe(ledger: DataFrame, drops: DataFrame, tokens: DataFrame, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """(ledger, audit): the rows whose hashes stand in ``tokens`` lose their flag, and the audit its rows of them."""
    hashes = led.hashes_in(tokens)
    left, gone = led.withdraw_drops(drops, hashes, "nsfw")
    if dry_run:
        return led.preview(ledger.join(hashes, F.lower("image_id") == F.col("id"), "left_semi"), 20, "row_id"), gone
    return led.clear_columns(led.unflag_by_keys(ledger, hashes.withColumnRenamed("id", "image_id"), "image_id", "is_unsafe"), hashes, "image_id", [c for c in ("is_unsafe_score", "is_unsafe_tags") if c in ledger.columns]), left


def resize(ledger: DataFrame, payloads: DataFrame, root: str, out_root: str, inpainted: Column, decoder: rasters.Decoder | None = None, encoder: Callable | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(ledger with sizes, status and ``out_path``, counts by status and action); pictures are written below ``out_root``.

    A picture that does not decode is ``error_open``; one that cannot be resized, encoded or written is ``error_save``.
    """
    chosen = rank.choose_source(led.ensure_columns(ledger, has_ocr="boolean", is_unsafe="boolean"), payloads, root, inpainted)
    seen = payloads.select(F.col("path").alias("source_path"), media.probe_upright(F.col("content")).alias("_image"))
    planned = materialize(rank.resize_plan(chosen.join(seen, "source_path", "left"), F.col("_image.w"), F.col("_image.h"), F.col("_image.fmt").isNotNull(), strict).drop("_image"), "resize-plan")
    ext = output_extension(F.col("source_used"), F.col("source_path"), F.lit(False))
    work = planned.where("status = 'ok'").select("row_id", F.col("source_path").alias("path"), "new_w", "new_h", "kernel", ext.alias("ext")).join(payloads, "path")
    made = work.select(F.concat(F.col("row_id").cast("string"), "ext").alias("name"), media.resized(decoder, encoder)("content", "new_w", "new_h", "kernel", "ext").alias("content"))
    written = materialize(write_files(made, out_root, F.col("name"), F.col("content")), "resized").select(F.regexp_extract("path", r"^(-?\d+)\.", 1).cast("long").alias("_r"), F.col("path").alias("_path"), F.col("status").alias("_saved"))
    saved = F.col("_saved") == "saved"
    joined = planned.join(written, F.col("row_id") == F.col("_r"), "left")
    failed = (F.col("status") == "ok") & ~F.coalesce(saved, F.lit(False))
    out = joined.withColumn("out_path", F.when(saved, F.concat(F.lit(out_root.rstrip("/") + "/"), "_path"))).withColumn("status_msg", F.when(failed, "not saved").otherwise(F.col("status_msg"))).withColumn("status", F.when(failed, "error_save").otherwise(F.col("status"))).drop("_r", "_path", "_saved")
    return out, led.status_counts(out, "status", "resize_action")


def detect_text(ledger: DataFrame, payloads: DataFrame, build: Callable[[], Detect], decoder: rasters.Decoder | None = None, rotations: tuple[int, ...] = (0,), short_side: int = 1024, grow: int = 3, dry_run: bool = False, **boxes: float) -> tuple[DataFrame, DataFrame]:
    """(ledger with ``has_ocr``, hits with boxes, mask and box document); unflagged rows only, a hit is never cleared."""
    known = led.ensure_columns(ledger, has_ocr="boolean")
    todo = led.anti_filter(known, "is_unsafe").where(~is_blank(F.col("path_raw")))
    if dry_run:
        return led.preview(todo, 20, "row_id"), todo.limit(0)
    asked = todo.select("row_id", F.col("path_raw").alias("path")).join(payloads, "path").withColumn("_image", media.probe_upright(F.col("content"))).select("row_id", "path", F.col("_image.w").alias("w"), F.col("_image.h").alias("h"), "content")
    found = media.text_boxes(detect_boxes(asked, build, decoder, rotations=rotations, short_side=short_side), **boxes).where(F.size("boxes") > 0)
    hits = materialize(found.select("row_id", "path", "w", "h", "boxes", media.mask_png("w", "h", "boxes", F.lit(grow)).alias("mask"), media.box_document(F.col("path"), F.col("w"), F.col("h"), F.col("boxes")).alias("document")), "text-hits")
    return led.mark_by_keys(known, hits, "row_id", "has_ocr"), hits


def inpaint_text(hits: DataFrame, payloads: DataFrame, paint: Callable, decoder: rasters.Decoder | None = None) -> DataFrame:
    """(row_id, path, content): the pictures of ``hits`` with their masks painted over; failures are null."""
    return hits.select("row_id", "path", "mask").join(payloads, "path").select("row_id", "path", media.painted(paint, decoder)("content", "mask").alias("content"))


def caption(base: DataFrame, payloads: DataFrame, build: Callable, tries: int = 3, overwrite: bool = False, dry_run: bool = False) -> DataFrame:
    """Sentences and tag documents for rows without a caption; a reply that does not parse leaves them blank."""
    known = led.ensure_columns(base, caption="string", tags="string")
    todo = led.pending(known, "caption", overwrite).where(blank_to_null(F.col("path")).isNotNull())
    if dry_run:
        return led.preview(todo, 20, "row_id")
    asked = todo.select("row_id", "image_id", "path").join(payloads, "path")
    replied = media.apply_model(asked, build, ["image_id", "content"], "reply string", tries).select("row_id", parse_caption(F.col("reply")).alias("x")).where("x IS NOT NULL")
    told = materialize(replied.select("row_id", F.col("x.sentence").alias("caption"), F.to_json("x.tags", {"ignoreNullFields": "false"}).alias("tags")), "captions")
    return _by_row(known, told, ["caption", "tags"])
