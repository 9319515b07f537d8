"""Near-duplicates by distance of 64-bit hashes: blocked self-join, clusters, best member, audit.

Equal hashes are one value with one representative, so thousands of copies never meet pairwise.  The bits that the
block does not fix are cut into m bands; values within ``threshold`` bits differ in at most threshold // m bits of one
of them.  Joining on the block and the neighbours of a band within that radius finds every such pair, with far fewer
candidates than all pairs of a block.

Where the threshold is so wide that bands hardly tell values apart, a block is cut into cells of some thousand values and
all pairs of cells are compared as arrays: a task holds two cells, and there are as many tasks as such pairs need.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.scalars import double_or, hamming, hash_of_hex, int_or, resolution, text, truthy
from siltstone.operators.components import components
from siltstone.operators.ledger import require_columns
from siltstone.storage import bounded_batches, materialize


#: Least width of a band in bits; narrower ones would hardly tell values apart.
BAND_BITS = 8
#: Values of a cell where blocks are compared whole, about, and pairs of cells a task.
CELL, CELL_PAIRS = 4_096, 8
PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("distance", pa.int32())])


def _cuts(threshold: int, prefix_bits: int) -> tuple[list[tuple[int, int]], int]:
    """Bands as (low, high) bits, and the radius within a band."""
    rest = 64 - prefix_bits
    n = max(1, min(threshold + 1, rest // BAND_BITS))
    cuts = [rest * i // n for i in range(n + 1)]
    return list(zip(cuts, cuts[1:])), threshold // n


def _bits(h: Column, low: int, high: int) -> Column:
    mask = (1 << (high - low)) - 1
    return F.shiftrightunsigned(h, low).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1))


def _masks(width: int, radius: int) -> list[int]:
    """All numbers of ``width`` bits with at most ``radius`` ones."""
    return [sum(1 << i for i in ones) for k in range(radius + 1) for ones in combinations(range(width), k)]


def close_values(values: DataFrame, threshold: int = 3, prefix_bits: int = 16) -> DataFrame:
    """Pairs (a, b, distance), a < b, of distinct ``h`` within ``threshold`` bits that agree in the leading bits.

    With ``prefix_bits=0`` every pair within the threshold is found.  A negative threshold finds none: only equal
    values are then alike.
    """
    if threshold < 0:
        return values.select(F.col("h").alias("a"), F.col("h").alias("b"), F.lit(0).alias("distance")).limit(0)
    h = F.col("h")
    block = F.shiftrightunsigned("h", 64 - prefix_bits) if prefix_bits else F.lit(0).cast("long")
    bands, radius = _cuts(threshold, prefix_bits)
    # Bands of which one agrees in more than a 256th of all pairs save less than their rows cost.
    if any(256 * len(bands) * len(_masks(high - low, radius)) >= 1 << (high - low) for low, high in bands):
        return _close_in_cells(values.select("h", block.alias("block")).where("h IS NOT NULL"), threshold)

    def keyed(probes: bool) -> DataFrame:
        made = []
        for i, (low, high) in enumerate(bands):
            own = _bits(h, low, high)
            near = F.transform(F.array(*[F.lit(m).cast("long") for m in _masks(high - low, radius)]), lambda m: own.bitwiseXOR(m)) if probes and radius else F.array(own)
            made.append(F.transform(near, lambda x: F.struct(F.lit(i).alias("band"), x.alias("bits"))))
        return values.select("h", block.alias("block"), F.explode(F.concat(*made)).alias("k")).select("h", "block", "k.*")

    x, y = keyed(True).alias("x"), keyed(False).alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("block", "band", "bits")]
    d = hamming(F.col("x.h"), F.col("y.h"))
    near = x.join(y, same[0] & same[1] & same[2] & (F.col("x.h") < F.col("y.h")) & (d <= threshold))
    # A pair is found in every band that is close enough; keep it where that happens first.
    first = F.coalesce(*[F.when(hamming(_bits(F.col("x.h"), low, high), _bits(F.col("y.h"), low, high)) <= radius, F.lit(i)) for i, (low, high) in enumerate(bands)])
    return near.where(first == F.col("x.band")).select(F.col("x.h").alias("a"), F.col("y.h").alias("b"), d.alias("distance"))


def _close_in_cells(values: DataFrame, threshold: int) -> DataFrame:
    """Pairs of distinct ``h`` of one ``block`` within ``threshold`` bits, by comparing all."""
    spark = values.sparkSession
    bounded_batches(spark)
    counted = values.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("n"))
    dealt = values.join(counted, "block").select("block", "h", F.pmod(F.xxhash64("h"), "n").alias("cell"))
    cells = materialize(dealt.groupBy("block", "cell").agg(F.collect_list("h").alias("hs")), "cells")
    pairs = cells.groupBy("block").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.expr("n * (n + 1) div 2"))).first()[0] or 0
    x, y = cells.alias("x"), cells.alias("y")
    met = x.join(y, (F.col("x.block") == F.col("y.block")) & (F.col("x.cell") <= F.col("y.cell")))
    # Asked for by number, so that few bytes with much work do not become few tasks.
    tasks = max(1, min(pairs, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pairs // CELL_PAIRS))))
    tiles = met.select(F.col("x.hs").alias("xs"), F.col("y.hs").alias("ys"), (F.col("x.cell") == F.col("y.cell")).alias("one")).repartition(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                xs, ys = (batch.column(c)[i].values.to_numpy() for c in ("xs", "ys"))
                one = batch.column("one")[i].as_py()
                for begin in range(0, len(xs), 64):
                    part = xs[begin : begin + 64]
                    d = np.bitwise_count(part[:, None].view(np.uint64) ^ ys[None, :].view(np.uint64))
                    p, q = np.nonzero(d <= threshold)
                    a, b, d = part[p], ys[q], d[p, q]
                    if one:
                        ahead = a < b
                        a, b, d = a[ahead], b[ahead], d[ahead]
                    if len(a):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(d.astype(np.int32))], schema=PAIRS)

    return tiles.mapInArrow(run, "a long, b long, distance int")


def clusters(df: DataFrame, hash_col: str, threshold: int = 3, prefix_bits: int = 16, least: int = 2) -> DataFrame:
    """Rows with a hash that belong to a cluster of at least ``least`` rows; adds ``h`` and ``cluster`` (its least hash)."""
    rows = df.withColumn("h", F.col(hash_col)).where("h IS NOT NULL")
    values = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    linked = components(close_values(values.select("h"), threshold, prefix_bits), "hash-clusters")
    labelled = values.join(linked, values.h == linked.id, "left").select("h", "n", F.coalesce("component", "h").alias("cluster"))
    large = labelled.groupBy("cluster").agg(F.sum("n").alias("_size")).where(F.col("_size") >= least).select("cluster")
    return rows.join(labelled.join(large, "cluster").select("h", "cluster"), "h")


def representatives(members: DataFrame, cluster: str, order: list[Column], carry: list[str]) -> DataFrame:
    """The first member of each cluster by ``order``, as an aggregate that combines before the shuffle."""
    key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    return members.groupBy(cluster).agg(F.min_by(F.struct(*carry), key).alias("rep"), F.min(key).alias("first"))


def near_duplicates(ledger: DataFrame, near_thresh: int = 3, prefix_hex: int = 4, min_cluster_size: int = 2) -> DataFrame:
    """One row per clustered record: group, rep_image_id, image_id, dupe_flag, ham_to_rep, kept, keep_reason, row_id.

    The best aesthetic score is kept, then the higher resolution, then the earlier time, then the earlier row.
    Distances are to the representative and may exceed the threshold where members are linked by others.
    """
    require_columns(ledger, "row_id", "image_id", "phash64", "is_unsafe")
    picked = ledger.where(~truthy(F.col("is_unsafe"))).withColumn("_hash", hash_of_hex(F.col("phash64")))
    size = {n: int_or(F.col(n)) if n in ledger.columns else F.lit(0) for n in ("new_w", "new_h", "w", "h")}
    aes = double_or(F.col("ae_aesthetic"), -1.0) if "ae_aesthetic" in ledger.columns else F.lit(-1.0)
    scored = picked.select("row_id", "image_id", "_hash", F.when(F.isnan(aes), F.lit(-1.0)).otherwise(aes).alias("_aes"), resolution(size["new_w"], size["new_h"], size["w"], size["h"]).alias("_res"), (text(F.col("ts")) if "ts" in ledger.columns else F.lit("")).alias("_ts"))
    members = clusters(scored, "_hash", near_thresh, 4 * prefix_hex, min_cluster_size)
    best = representatives(members, "cluster", [-F.col("_aes"), -F.col("_res"), F.col("_ts"), F.col("row_id")], ["row_id", "image_id", "h", "_aes"])
    ties = members.groupBy("cluster", "_aes").agg(F.count(F.lit(1)).alias("_tied")).join(best.select("cluster", F.col("rep._aes").alias("_aes")), ["cluster", "_aes"]).select("cluster", "_tied")
    joined = members.join(best.select("cluster", "rep").join(ties, "cluster"), "cluster")
    kept = F.col("row_id") == F.col("rep.row_id")
    ham = hamming(F.col("h"), F.col("rep.h"))
    return joined.select(
        F.concat(F.lit("group_"), "rep.image_id").alias("group"), F.col("rep.image_id").alias("rep_image_id"), "image_id",
        F.when(kept, "").when(ham == 0, "identical").otherwise("near").alias("dupe_flag"), ham.cast("int").alias("ham_to_rep"), kept.alias("kept"),
        F.when(~kept, "").when(F.col("_tied") > 1, "highest_resolution").otherwise("highest_aesthetic").alias("keep_reason"), "row_id",
    )


def annotate(ledger: DataFrame, audit: DataFrame, removed_at: Column, params: str = "{}") -> DataFrame:
    """The ledger with the duplicate columns of its clustered rows; other rows keep what they had."""
    extra = audit.select(F.col("row_id").alias("_r"), F.col("group").alias("dupe_group"), "dupe_flag", F.col("ham_to_rep").alias("dupe_score_min"), F.col("rep_image_id").alias("dupe_rep_image"), (~F.col("kept")).alias("dupe_removed"), F.when(~F.col("kept"), removed_at).alias("dupe_removed_at"), F.col("keep_reason").alias("dupe_keep_reason"), F.lit("phash_auto").alias("dupe_method"), F.lit(params).alias("dupe_params"))
    names = [c for c in extra.columns if c != "_r"]
    joined = ledger.alias("l").join(extra.alias("e"), F.col("l.row_id") == F.col("e._r"), "left")
    found = F.col("e._r").isNotNull()
    return joined.select(*[F.col(f"l.{c}") for c in ledger.columns if c not in names], *[(F.when(found, F.col(f"e.{n}")).otherwise(F.col(f"l.{n}")) if n in ledger.columns else F.col(f"e.{n}")).alias(n) for n in names])
