"""Text detection with an injected detector: enlarged and rotated views, boxes mapped back to the original picture."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from siltstone.functions import rasters
from siltstone.storage import bounded_batches

#: detect(pixels) -> (corners, confidence) pairs.
Detect = Callable[[np.ndarray], list[tuple[Any, Any]]]
BOXES = "boxes array<struct<points: array<array<double>>, conf: double>>"


def confidence_of(field: Any) -> float:
    """A number, the number of a (text, number) pair or the score of a dict; 1 where there is none."""
    if isinstance(field, (list, tuple)):
        field = field[1] if len(field) > 1 else None
    elif isinstance(field, dict):
        field = field.get("score")
    try:
        return 1.0 if field is None or isinstance(field, str) else float(field)
    except (TypeError, ValueError):
        return 1.0


def views(pixels: np.ndarray, rotations: tuple[int, ...] = (0,), short_side: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(picture, map): the picture enlarged to a short side and rotated, and the 2 x 3 map of its points to the original."""
    h, w = pixels.shape[:2]
    scale = short_side / min(h, w) if short_side and min(h, w) < short_side else 1.0
    large = rasters.resize(pixels, round(w * scale), round(h * scale), "BICUBIC") if scale != 1.0 else pixels
    for degrees in rotations:
        turn = rasters.rotation(*large.shape[:2], degrees)
        back = np.linalg.inv(np.vstack([turn, [0, 0, 1]]))[:2] / scale
        yield (large if degrees % 360 == 0 else rasters.rotate(large, degrees)), back


def found_in(pixels: np.ndarray, detect: Detect, rotations: tuple[int, ...] = (0,), short_side: int = 1024) -> list[dict]:
    """Boxes of all views in coordinates of the original; a view on which the detector fails has none."""
    out = []
    for view, back in views(pixels, rotations, short_side):
        try:
            hits = detect(view)
        except Exception:  # the detector is injected; a failed view finds nothing
            hits = []
        for corners, conf in hits or []:
            points = np.asarray(corners, float) @ back[:, :2].T + back[:, 2]
            out.append({"points": points.tolist(), "conf": confidence_of(conf)})
    return out


def detect_boxes(df: DataFrame, build: Callable[[], Detect], decoder: rasters.Decoder | None = None, content: str = "content", rotations: tuple[int, ...] = (0,), short_side: int = 1024, recognise: Callable[[], Callable[[np.ndarray], float]] | None = None) -> DataFrame:
    """Adds ``boxes`` (empty where the picture does not decode) and, with ``recognise``, the best confidence ``rec`` of
    recognising text in each box with a margin of two pixels."""
    ddl = BOXES if recognise is None else BOXES.replace("conf: double", "conf: double, rec: double")
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detect, read = build(), recognise() if recognise is not None else None

        def one(blob) -> list[dict]:
            try:
                pixels = rasters.decode(blob, decoder)
            except Exception:  # any decoder may fail in its own way
                return []
            boxes = found_in(pixels, detect, rotations, short_side)
            for box in boxes if read is not None else ():
                (x0, y0), (x1, y1) = np.floor(np.min(box["points"], axis=0)).astype(int), np.floor(np.max(box["points"], axis=0)).astype(int) + 1
                crop = pixels[max(0, y0 - 2) : y1 + 2, max(0, x0 - 2) : x1 + 2]
                try:
                    box["rec"] = float(read(crop)) if crop.size else 0.0
                except Exception:  # the recogniser is injected
                    box["rec"] = 0.0
            return boxes

        for pdf in batches:
            yield pdf.assign(boxes=[one(b) for b in pdf[content]])

    bounded_batches(df.sparkSession, rows=64, megabytes=64)
    return df.mapInPandas(run, schema)
