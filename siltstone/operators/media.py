"""Image stages over binary columns, with models that the caller injects.

Payloads pass through Arrow batches that are bounded by bytes; each function is built once in a Python worker.
Failures are rows with a status, never exceptions, so one broken file does not end a job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import rasters
from siltstone.functions.polygons import is_round, polygons
from siltstone.storage import bounded_batches

FORMATS, LEAST_SIDE = ("JPEG", "PNG", "WEBP"), 128


_IMAGE = T.StructType([T.StructField("fmt", T.StringType()), T.StructField("w", T.IntegerType()), T.StructField("h", T.IntegerType())])


def _told(blob: bytes | None) -> tuple:
    return (rasters.probe(blob) if rasters.intact(blob) else None) or (None, None, None)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["fmt", "w", "h"]).astype({"w": "Int32", "h": "Int32"})


@F.pandas_udf(_IMAGE)
def probe(content: pd.Series) -> pd.DataFrame:
    """Format and size from the file's header; nulls for anything that is no image, or not a whole one."""
    return _frame([_told(b) for b in content])


@F.pandas_udf(_IMAGE)
def probe_upright(content: pd.Series) -> pd.DataFrame:
    """As ``probe``, with the size of the picture as it is meant to be seen."""
    told = [(b, _told(b)) for b in content]
    return _frame([(fmt, h, w) if fmt == "JPEG" and rasters.orientation(b) >= 5 else (fmt, w, h) for b, (fmt, w, h) in told])


def is_valid(image: Column, least_side: int = LEAST_SIDE) -> Column:
    return F.coalesce(image["fmt"].isin(*FORMATS) & (F.least(image["w"], image["h"]) >= least_side), F.lit(False))


def identified(df: DataFrame, content: str = "content", least_side: int = LEAST_SIDE) -> DataFrame:
    """Adds ``image_id`` (MD5 of the bytes), ``fmt``, ``w``, ``h`` and ``valid``."""
    bounded_batches(df.sparkSession, rows=64, megabytes=64)
    image = df.withColumn("_image", probe(F.col(content)))
    return image.withColumns({"image_id": F.md5(content), "fmt": F.col("_image.fmt"), "w": F.col("_image.w"), "h": F.col("_image.h"), "valid": is_valid(F.col("_image"), least_side)}).drop("_image")


def perceptual_hash(decoder: rasters.Decoder | None = None):
    """A function of image bytes: the 64-bit hash, null where the image does not decode."""

    @F.pandas_udf(T.LongType())
    def run(content: pd.Series) -> pd.Series:
        def one(blob):
            try:
                return rasters.perceptual_hash(rasters.decode(blob, decoder))
            except Exception:  # any decoder may fail in its own way; the row says so by its null
                return None

        return pd.Series([None if b is None else one(b) for b in content], dtype="Int64")

    return run


def hash_source(df: DataFrame) -> Column:
    """The path to hash: the raw file of unsafe records, else an absolute output path, else the resized one."""
    from siltstone.functions.scalars import blank_to_null, truthy

    out = F.when(F.col("out_path").startswith("/"), F.col("out_path"))
    return F.when(truthy(F.col("is_unsafe")), F.col("path_raw")).otherwise(F.coalesce(blank_to_null(out), blank_to_null(F.col("path_resized"))))


def apply_model(df: DataFrame, build: Callable[[], Callable[[dict[str, Any]], dict[str, Any]]], inputs: list[str], outputs: str, tries: int = 1) -> DataFrame:
    """Call a model for each row: ``build()`` makes it once in a worker, and it maps a dict of ``inputs`` to ``outputs``.

    A call that raises or returns None is repeated with ``attempt`` raised, ``tries`` times at most; then ``status`` is
    ``failed`` and the outputs are null.  Filter before this step: a function is a barrier for filters.
    """
    fields = T.StructType.fromDDL(outputs)
    schema = T.StructType([*df.schema.fields, *fields.fields, T.StructField("status", T.StringType()), T.StructField("attempts", T.IntegerType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = build()
        for pdf in batches:
            made: list[dict[str, Any]] = []
            for row in pdf[inputs].to_dict("records"):
                out, attempt = None, 0
                while out is None and attempt < tries:
                    attempt += 1
                    try:
                        out = model(row | {"attempt": attempt})
                    except Exception:  # whatever the injected model raises counts as a failed attempt
                        out = None
                made.append({f.name: (out or {}).get(f.name) for f in fields} | {"status": "failed" if out is None else "ok", "attempts": attempt})
            extra = pd.DataFrame(made, index=pdf.index, columns=[*[f.name for f in fields], "status", "attempts"])
            yield pd.concat([pdf, extra], axis=1)

    bounded_batches(df.sparkSession, rows=64, megabytes=64)
    return df.mapInPandas(run, schema)


def temperature(base: float, attempt: int, step: float = 0.05) -> float:
    """Sampling temperature of a repeated attempt."""
    return min(1.0, base + step * (attempt - 1))


def text_boxes(df: DataFrame, boxes: str = "boxes", least_conf: float = 0.35, least_area: float = 150.0, reject_round: bool = True, recheck: float = 0.0, **roundness: float) -> DataFrame:
    """Keeps the boxes that are large, confident and not round; adds ``has_ocr``, which a hit sets and a miss does not clear.

    With ``recheck`` above 0 boxes also need a field ``rec``, the confidence of recognising text in them, that reaches it.
    """
    rec = F.col(f"{boxes}.rec") if recheck > 0 else F.transform(boxes, lambda b: F.lit(1.0))
    shaped = F.arrays_zip(F.col(f"{boxes}.points").alias("points"), F.col(f"{boxes}.conf").alias("conf"), F.col("_shapes").alias("shape"), rec.alias("rec"))
    out = df.withColumn("_shapes", polygons(F.col(f"{boxes}.points"))).withColumn("_b", shaped).drop("_shapes")
    good = F.filter("_b", lambda b: (b["shape"]["area"] >= least_area) & (b["conf"] >= least_conf) & (b["rec"] >= recheck) & (~is_round(b["shape"], **roundness) if reject_round else F.lit(True)))
    kept = F.transform(good, lambda b: F.struct(b["points"].alias("points"), b["conf"].alias("conf"), b["shape"]["area"].alias("area")))
    old = F.coalesce(F.col("has_ocr"), F.lit(False)) if "has_ocr" in df.columns else F.lit(False)
    return out.withColumn(boxes, kept).withColumn("has_ocr", F.when(F.size(boxes) > 0, F.lit(True)).otherwise(old)).drop("_b")


def box_document(image: Column, w: Column, h: Column, boxes: Column) -> Column:
    return F.to_json(F.struct(image.alias("image"), w.alias("width"), h.alias("height"), boxes.alias("boxes")))


@F.pandas_udf(T.BinaryType())
def mask_png(w: pd.Series, h: pd.Series, boxes: pd.Series, grow: pd.Series) -> pd.Series:
    """The mask of all boxes, grown by ``grow`` pixels, as a PNG."""

    def one(width, height, found, g):
        polygons = [np.array([np.asarray(p, float) for p in b["points"]]) for b in found]
        return rasters.encode_png(rasters.dilate(rasters.fill_polygons(int(height), int(width), polygons), int(g)))

    return pd.Series([one(*x) for x in zip(w, h, boxes, grow)])


def resized(decoder: rasters.Decoder | None = None, encoder: Callable[[np.ndarray, str], bytes] | None = None):
    """A function (content, new_w, new_h, kernel, extension) -> bytes of the resized image, null where it fails."""

    @F.pandas_udf(T.BinaryType())
    def run(content: pd.Series, w: pd.Series, h: pd.Series, kernel: pd.Series, ext: pd.Series) -> pd.Series:
        def one(blob, width, height, how, e):
            try:
                if how == "KEEP":
                    return blob
                pixels = rasters.resize(rasters.decode(blob, decoder), int(width), int(height), how)
                return encoder(pixels, e) if encoder is not None and e != ".png" else rasters.encode_png(pixels)
            except Exception:  # decoders and encoders are injected; a null marks error_save
                return None

        return pd.Series([one(*x) for x in zip(content, w, h, kernel, ext)], dtype=object)

    return run


def painted(paint: Callable[[np.ndarray, np.ndarray], np.ndarray], decoder: rasters.Decoder | None = None, tile: int = 1024, overlap: int = 64, above: int = 8_000_000):
    """A function (content, mask) -> PNG with the masked parts painted over by the injected model."""

    @F.pandas_udf(T.BinaryType())
    def run(content: pd.Series, mask: pd.Series) -> pd.Series:
        def one(blob, m):
            try:
                pixels = rasters.decode(blob, decoder)
                holes = rasters.fit_mask(rasters.decode_png(m)[:, :, 0], *pixels.shape[:2])
                return rasters.encode_png(rasters.blend_tiles(pixels, holes, paint, tile, overlap, above))
            except Exception:  # the painter is injected; a null marks the failure
                return None

        return pd.Series([one(*x) for x in zip(content, mask)], dtype=object)

    return run


def stub_scores(seed: str = "") -> Callable[[], Callable[[dict], dict]]:
    """A deterministic stand-in for a vision scorer: replies with JSON made from a hash of ``image_id``."""

    def build():
        import hashlib

        def call(row):
            d = hashlib.md5(f"{seed}{row['image_id']}".encode()).digest()
            return {"reply": json.dumps({"relevance": d[0] % 101, "aesthetic": d[1] % 101})}

        return call

    return build
