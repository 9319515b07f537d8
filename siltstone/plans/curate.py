"""Whole plans from operators: a ledger becomes a base table, and a base table becomes a packed dataset."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.operators import captions, dedup, groups, rank
from siltstone.sinks.payloads import clear_shards, sample_metadata, split_stats, write_shards
from siltstone.storage import materialize


@dataclass(frozen=True)
class Curation:
    near_thresh: int = 3
    prefix_hex: int = 4
    min_cluster_size: int = 2
    top_n: int = 16_000
    min_relevance: float = 60
    min_aesthetic: float = 60


def curate(ledger: DataFrame, files: DataFrame, now: str, how: Curation = Curation()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(base, audit, missing) of a scored and hashed ledger with ``row_id``."""
    audit = materialize(dedup.near_duplicates(ledger, how.near_thresh, how.prefix_hex, how.min_cluster_size), "dedup-audit")
    params = json.dumps({"near_thresh": how.near_thresh, "prefix_hex": how.prefix_hex})
    marked = dedup.annotate(ledger.drop("dupe_removed"), audit, F.lit(now), params)
    marked = marked.withColumn("dupe_removed", F.coalesce("dupe_removed", F.lit(False)))
    best = rank.quality_filter(marked, how.top_n, how.min_relevance, how.min_aesthetic)
    resolved = rank.with_payload(best, files, "path_resized", "out_path")
    return rank.base_table(resolved.where("status = 'ok'")), audit, resolved.where("status = 'missing'").select("image_id")


def caption_base(base: DataFrame, corrected: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(base with hybrid captions, rows to caption again)."""
    merged = base if corrected is None else captions.upsert(base, corrected)
    good, bad = captions.screen(merged)
    return captions.hybrid_captions(good), captions.recap_rows(bad)


def package(base: DataFrame, payloads: DataFrame, root: str, train_shards: int = 16, seed: int = 42, least_count: int = 0, overwrite: bool = False) -> tuple[DataFrame, str]:
    """Normalise names, split, and pack; returns (shard table, statistics JSON).

    Payloads (path, content) are known by path before ids are made unique, so a missing file does not claim its id;
    split, shard and place are decided on keys, and the bytes join last, on their way into the shards.
    """
    if overwrite:
        clear_shards(base.sparkSession, root)
    kept, _ = groups.normalise_tags(base)
    counted = groups.counts(kept, F.split("species", ", "), least_count).where("pokemon <> ''")
    split = groups.quota_split(kept, groups.quotas_by_rank(counted), seed)
    present = split.join(payloads.select("path"), "path", "left_semi")
    unique = materialize(groups.unique_by_id(present, seed=seed), "package")
    shards = []
    for name, n in (("train", train_shards), ("val", 1)):
        part = unique.where(F.col("split") == name)
        dealt = sample_metadata(groups.assign_shards(part, n, seed=seed)).join(payloads.select("path", "content"), "path")
        shards.append(materialize(write_shards(dealt, root, f"{name}/{name}-%05d.tar", n), f"shards-{name}"))
    rows = {r["split"]: (f"ids/{r['split']}.txt", r["count"], r["sha256"]) for r in groups.manifest(unique).collect()}
    return shards[0].unionByName(shards[1]), split_stats(groups.split_totals(unique).first().asDict(), rows)
