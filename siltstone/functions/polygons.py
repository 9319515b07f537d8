"""Measures of polygons as Arrow functions: whole batches in numpy, any number of corners, exact hulls."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.rasters import convex_hull_area

_FIELDS = ("area", "circularity", "aspect", "solidity")
SHAPE = T.StructType([T.StructField(name, T.DoubleType()) for name in _FIELDS])


def measures(x: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(4, n) area, circularity, aspect and solidity of polygons whose corners lie end to end.

    The area follows the shoelace formula, ``aspect`` is that of the box around whole pixels, ``solidity`` the share of
    the convex hull.  A polygon without corners measures 0 throughout.
    """
    out = np.zeros((4, len(sizes)))
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    n = sizes[full]
    starts = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(full)), n)
    place = np.arange(len(x)) - starts[owner]

    def ahead(k: int) -> np.ndarray:
        return starts[owner] + (place + k) % n[owner]

    one, two = ahead(1), ahead(2)
    dx, dy = x[one] - x, y[one] - y
    area = np.abs(np.add.reduceat(x * y[one] - x[one] * y, starts)) / 2
    around = np.add.reduceat(np.sqrt(dx * dx + dy * dy), starts)
    wide, high = (np.maximum.reduceat(np.trunc(v), starts) - np.minimum.reduceat(np.trunc(v), starts) + 1 for v in (x, y))
    turns = np.sign(dx * (y[two] - y[one]) - dy * (x[two] - x[one]))
    dented = (np.maximum.reduceat(turns, starts) > 0) & (np.minimum.reduceat(turns, starts) < 0)
    hull = area.copy()
    for i in np.flatnonzero(dented | (n > 4)):  # four corners that turn one way are convex
        part = slice(starts[i], starts[i] + n[i])
        hull[i] = convex_hull_area(np.stack([x[part], y[part]], axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        out[:, full] = area, np.where(around > 0, 4 * np.pi * area / (around * around), 0.0), wide / high, np.where(hull > 0, area / hull, 0.0)
    return out


def _shapes(polygons: pa.ListArray) -> pa.StructArray:
    corners = polygons.flatten()
    sizes = np.asarray(polygons.value_lengths().fill_null(0))
    if len(corners):
        pairs = np.asarray(corners.value_lengths())
        flat = corners.flatten().to_numpy(zero_copy_only=False)
        first = np.cumsum(pairs) - pairs
        x, y = flat[first], flat[first + 1]
    else:
        x = y = np.zeros(0)
    return pa.StructArray.from_arrays([pa.array(v) for v in measures(x, y, sizes)], names=list(_FIELDS))


@F.arrow_udf(SHAPE)
def polygon(corners: pa.Array) -> pa.Array:
    """Struct (area, circularity, aspect, solidity) of array<array<double>> corners."""
    return _shapes(corners)


@F.arrow_udf(T.ArrayType(SHAPE))
def polygons(listed: pa.Array) -> pa.Array:
    """The shapes of a list of polygons."""
    counts = np.asarray(listed.value_lengths().fill_null(0))
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), _shapes(listed.flatten()))


def is_round(shape: Column, circularity: float = 0.78, low: float = 0.75, high: float = 1.33, solidity: float = 0.95) -> Column:
    return (shape["area"] > 0) & (shape["circularity"] >= circularity) & shape["aspect"].between(low, high) & (shape["solidity"] >= solidity)
