"""Collection: quotas become queries, results become fetched and validated records within their quotas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.functions.scalars import domain, extension, folder_name
from siltstone.operators.ledger import attempt_status, first_seen, ledger_rows
from siltstone.operators.media import identified
from siltstone.sources.search import Fetch, fetch_payloads, requests_for, search
from siltstone.storage import materialize


def collect(
    spark: SparkSession, quotas: DataFrame, fetch: Fetch, client: Callable[[], Callable[[str], tuple[bytes, str] | None]], suffix: str, run_id: str, now: str,
    present: DataFrame | None = None, pages: int = 50, rate: float | None = 1.5, least_side: int = 128, safe: str = "active",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ledger rows, attempt log rows, payloads with path) of one run.

    ``present`` (species, image_id) holds what earlier runs saved: it counts towards the quota, and the same payload in
    the same group is a duplicate.  The first successes in order of arrival fill a quota; what was fetched beyond it
    is logged but not kept.  Quotas are a small table, one row per group, and their queries are asked in a few lanes.
    """
    wanted = requests_for(quotas, suffix).collect()  # one row per group
    asked = spark.createDataFrame(wanted, requests_for(quotas, suffix).schema)
    results = search(spark, fetch, [r["query"] for r in wanted], pages, rate).join(asked, "query")
    fresh = first_seen(results.withColumn("_at", F.struct("page", "position")), "Name", "url", "_at")
    fetched = materialize(identified(fetch_payloads(fresh, client), least_side=least_side), "fetched")
    old = spark.createDataFrame([], "species string, image_id string") if present is None else present.select("species", "image_id")
    known = old.distinct().withColumn("_old", F.lit(True))
    told = fetched.withColumn("species", F.col("Name")).join(known, ["species", "image_id"], "left")
    again = F.row_number().over(Window.partitionBy("species", "image_id").orderBy("_at")) > 1
    exists = F.coalesce(F.col("_old"), F.lit(False)) | (F.col("valid") & again)
    ranked = told.withColumn("status", attempt_status(F.col("content").isNotNull(), F.col("valid"), exists, F.lit(None).cast("string")))
    have = old.groupBy("species").agg(F.count(F.lit(1)).alias("_have"))
    nth = F.sum(F.when(F.col("status") == "saved", 1).otherwise(0)).over(Window.partitionBy("species").orderBy("_at"))
    placed = ranked.withColumn("_n", nth).join(have, "species", "left").withColumn("_need", F.greatest(F.lit(0), F.col("q_r_base") - F.coalesce("_have", F.lit(0))))
    path = F.concat_ws("/", F.lit("data_raw"), "band_label", folder_name(F.col("Ranking"), F.col("Name")), F.lit("imgs"), F.concat("image_id", extension(F.col("url"), F.col("fmt"))))
    rows = materialize(placed.withColumn("path_raw", path).withColumn("_kept", (F.col("status") == "saved") & (F.col("_n") <= F.col("_need"))), "collected")
    named = rows.withColumns({"ts": F.lit(now), "scrape_run_id": F.lit(run_id), "rank": F.col("Ranking"), "band": F.col("band_label"), "source_url": F.col("url"), "source_domain": domain(F.col("url")), "safe": F.lit(safe), "hl": F.lit("en"), "gl": F.lit("us")})
    attempt = named.select("ts", F.lit("attempt").alias("status"), "url", "scrape_run_id", "species", "rank", "band", "query", F.lit(None).cast("string").alias("hash"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("string").alias("fmt"), F.lit(None).cast("int").alias("w"), F.lit(None).cast("int").alias("h"), F.lit(None).cast("string").alias("content_type"))
    there = F.col("status").isin("saved", "duplicate_existing")
    outcome = named.select("ts", "status", "url", "scrape_run_id", "species", "rank", "band", "query", F.when(there, F.col("image_id")).alias("hash"), F.when(there, F.col("path_raw")).alias("path"), F.when(there, F.col("fmt")).alias("fmt"), F.when(there, F.col("w")).alias("w"), F.when(there, F.col("h")).alias("h"), "content_type")
    kept = named.where("_kept")
    return ledger_rows(kept), attempt.unionByName(outcome), kept.select("path_raw", "content")
