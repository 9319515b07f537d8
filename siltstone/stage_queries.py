"""Further operators as queries: scalars and tag documents, ledger steps, sources and sinks by round trip, media, plans.

Tables are written below the shared folder where a source or sink needs files; models, clients and pictures are small
functions of the key, so that SQL can tell what they give.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import documents as d
from siltstone.functions import rasters
from siltstone.functions import scalars as s
from siltstone.functions.polygons import polygon
from siltstone.operators import captions, groups, ledger, media, rank
from siltstone.operators.detect import detect_boxes
from siltstone.plans import stages
from siltstone.plans.collect import collect
from siltstone.sinks import payloads as packing
from siltstone.sinks import tables as sinks
from siltstone.sources import search, tables as sources
from siltstone.storage import materialize, scratch_path
from siltstone.streaming import attempts

NOW = "2024-05-06T07:08:09Z"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(key: Column, *options: str | None) -> Column:
    """One of the texts by the key's remainder."""
    return F.element_at(F.array(*[F.lit(x) for x in options]), (key % len(options) + 1).cast("int"))


def names_and_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query text, path parts, stems, suffixes, resolved paths, output extensions."""
    k = F.col("p_partkey")
    path = F.concat(_pick(k, "/data/raw/", "imgs/a.b/", ""), F.replace("p_name", F.lit(" "), F.lit("_")), _pick(k, ".PNG", ".jpeg", "", ".tar.gz", ".bmp"))
    rows = _table(spark, sf_dir, "part").select("p_partkey", "p_name", path.alias("path"), _pick(k, "inpainted", "raw", "raw", "raw").alias("used"), (k % 3 == 0).alias("alpha"))
    return rows.select("p_partkey", s.query_text(F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("\t  "))), "fan art").alias("query"), s.path_part(F.col("path"), 1).alias("file"), s.path_part(F.col("path"), 2).alias("folder"), s.stem_of(F.col("path")).alias("stem"), s.suffix_of(F.col("path")).alias("suffix"), s.resolve("/root/", F.col("path")).alias("resolved"), s.output_extension(F.col("used"), F.col("path"), F.col("alpha")).alias("ext"))


def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    raw = _pick(k, " 7.9 ", "x", "", None, "-3", "1e3", "12")
    return _table(spark, sf_dir, "part").select("p_partkey", s.int_or(raw).alias("whole"), s.double_or(raw, -1.0).alias("number"), s.text(raw).alias("said"), s.blank_to_null(raw).alias("kept"))


def stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("o_orderdate").cast("timestamp")
    return _table(spark, sf_dir, "orders").select("o_orderkey", s.utc_text(at).alias("ts"), s.run_id("scr", at).alias("run"))


def hit_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags with their scores, highest first, and a comma-joined list as names."""
    tags = ("a", "b", "c")
    scores = F.create_map(*[x for i, t in enumerate(tags) for x in (F.lit(t), F.when(F.col("embedding")[i] > -0.05, F.round(F.col("embedding")[i].cast("double"), 2)))])
    listed = F.concat_ws(",", F.lit(" Ab "), F.lit(""), F.col("label").cast("string"), F.lit("X y"))
    return _table(spark, sf_dir, "embeddings").select("vec_id", s.hit_text(s.ranked_hits(scores, tags)).alias("hits"), F.array_join(s.list_of(listed), "|").alias("names"))


def last_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON blocks at the end of replies, and the sentence and tags of a captioner's reply."""
    k = F.col("p_partkey")
    block = F.concat(F.lit('{"sentence": "'), F.col("p_name"), F.lit('. And more.", "tags": {"pose": ["Sitting Down"]}}'))
    reply = F.when(k % 4 == 0, F.concat(F.lit("Sure: "), block)).when(k % 4 == 1, F.concat(F.lit("```json\n"), block, F.lit("\n```"))).when(k % 4 == 2, F.concat(block, F.lit(" done"))).otherwise("none")
    rows = _table(spark, sf_dir, "part").select("p_partkey", reply.alias("reply")).withColumn("c", d.parse_caption(F.col("reply")))
    return rows.select("p_partkey", d.last_json_block(F.col("reply")).isNotNull().alias("has_block"), F.col("c.sentence").alias("sentence"), F.array_join("c.tags.pose", ",").alias("pose"), F.col("c.tags.subject_count").alias("subjects"))


def coerced_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag documents brought to their schema: aligned forms, closed vocabularies, two compositions, snake lists."""
    k = F.col("p_partkey")
    doc = F.to_json(F.struct(
        F.array("p_name", F.lit("Mew Two"), "p_name").alias("Pokémon"), F.array(F.when(k % 2 == 0, "Mega X"), F.lit(None).cast("string"), F.when(k % 2 == 0, "Mega X"), F.lit("Extra")).alias("form"),
        F.when(k % 3 == 0, "yes").otherwise("no").alias("shiny_presence"), F.array(F.lit("Chef Hat"), F.lit("chef-hat"), F.lit(""), F.lit(None).cast("string"), F.lit(None).cast("string")).alias("props"),
        F.array(F.lit("close_up"), F.lit("nonsense"), F.lit("portrait"), F.lit("close_up"), F.lit("full_body")).alias("composition"), _pick(k, "single", "multiple", "many").alias("subject_count"),
    ), {"ignoreNullFields": "false"})
    raw = F.when(k % 7 == 0, F.lit("[1]")).otherwise(doc)
    out = _table(spark, sf_dir, "part").select("p_partkey", d.parse(raw).alias("v")).select("p_partkey", d.coerce_tags(F.col("v")).alias("t"), F.array_join(d.name_list(F.col("v")), "|").alias("listed"))
    return out.select("p_partkey", F.array_join("t.names", "|").alias("names"), F.array_join("t.form", "|", "-").alias("forms"), F.col("t.shiny_presence").alias("shiny"), F.array_join("t.props", "|", "-").alias("props"), F.size("t.composition").alias("n_composition"), F.col("t.subject_count").alias("subjects"), F.col("t.trimmed").alias("trimmed"), "listed")


def confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    raw = _pick(k, "0.25", '["text", 0.5]', '{"score": 0.75}', '"word"', "null", "[]")
    return _table(spark, sf_dir, "part").select("p_partkey", d.confidence(F.parse_json(raw)).alias("conf"))


def data_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    return _table(spark, sf_dir, "pages").select("page_id", F.md5(s.data_url(_pick(k, "a.PNG", "b.webp", "c"), F.encode(F.col("url"), "UTF-8"))).alias("digest"))


def aspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = (F.col("l_quantity").cast("int") % 37), F.col("l_linenumber")
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", s.aspect(w, h).alias("aspect"), s.size_text(w, h).alias("size"))


def polygon_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six corners: a rectangle with a notch, whose hull is a pentagon; area, circularity and solidity."""
    w, h = F.col("l_quantity"), F.col("l_linenumber") * 10.0
    zero = F.lit(0.0)
    corners = F.array(*[F.array(x.cast("double"), y.cast("double")) for x, y in ((zero, zero), (w * 2, zero), (w * 2, h), (w, h), (w, h * 2), (zero, h * 2))])
    shaped = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", polygon(corners).alias("p"))
    return shaped.select("l_orderkey", "l_linenumber", F.round("p.area", 4).alias("area"), F.round("p.circularity", 6).alias("circularity"), F.round("p.aspect", 6).alias("aspect"), F.round("p.solidity", 6).alias("solidity"))


def base_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows with the first path that exists, as the base table; rows without a file are missing."""
    k = F.col("c_custkey")
    rows = _table(spark, sf_dir, "customer").select(k.cast("string").alias("image_id"), F.lit("u").alias("source_url"), (k % 50).alias("ae_relevance"), (k % 30).alias("ae_aesthetic"), F.lit("0f").alias("phash64"), (k % 5 * 100).alias("new_w"), F.lit(64).alias("new_h"), F.when(k % 2 == 0, F.concat(F.lit("/a/"), k)).otherwise("").alias("path_resized"), F.concat(F.lit("/b/"), k).alias("out_path"))
    files = _table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.concat(F.when(k % 4 == 0, "/a/").otherwise("/b/"), k).alias("path"))
    return rank.base_table(rank.with_payload(rows, files, "path_resized", "out_path").where("status = 'ok'"))


def source_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Painted file, raw file or none; target size, kernel and status of each."""
    k = F.col("c_custkey")
    rows = _table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("raw/"), k).alias("path_raw"), (k % 2 == 0).alias("has_ocr"), (k % 11 == 0).alias("is_unsafe"), (k % 40 * 100 + 100).cast("int").alias("w"), (k % 7 * 300 + 200).cast("int").alias("h"), (k % 13 != 0).alias("opens"))
    files = _table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(F.explode(F.array(F.concat(F.lit("/root/raw/"), k), F.concat(F.lit("/paint/"), k))).alias("path")).where("path LIKE '/root/%' OR path LIKE '%2' OR path LIKE '%4'")
    chosen = rank.choose_source(rows, files, "/root", F.concat(F.lit("/paint/"), k))
    planned = rank.resize_plan(chosen, F.col("w"), F.col("h"), F.col("opens"))
    return planned.select("c_custkey", "source_used", "source_path", "status", "status_msg", "new_w", "new_h", "resize_action", "ar_before")


def hash_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = _table(spark, sf_dir, "customer").select("c_custkey", (k % 3 == 0).alias("is_unsafe"), F.concat(F.lit("raw/"), k).alias("path_raw"), F.concat(_pick(k, "/out/", "out/", ""), k).alias("out_path"), _pick(k, "r", "", None, "x").alias("path_resized"))
    return rows.select("c_custkey", media.hash_source(rows).alias("path"))


def unique_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each repeated id: train before val, then by seeded hash of the path."""
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("image_id"), F.when(F.col("l_linenumber") == 1, "val").otherwise("train").alias("split"), F.concat_ws("/", "l_orderkey", "l_linenumber").alias("path"))
    return groups.unique_by_id(rows).select("image_id", "split", "path")


def unflag_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in any letter case clear a flag, other rows keep it; the key column is the first both sides have."""
    rows = _table(spark, sf_dir, "customer").select(F.col("c_name").alias("path"), "c_custkey", (F.col("c_custkey") % 2 == 0).alias("has_ocr"))
    keys = rows.where("c_custkey % 4 = 0").select(F.concat(F.lit(" "), F.upper("path")).alias("path"))
    return ledger.unflag_by_keys(rows, keys, ledger.choose_key(rows, keys), "has_ocr").select("c_custkey", "has_ocr")


def row_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A changed row, a new row, and the row of one file by its stem."""
    rows = _table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lower("n_name"), F.lit(".png")).alias("path"))
    by_stem = ledger.single_row(rows, "path", "nation_7.jpg").withColumn("path", F.lit("changed.png"))
    new = by_stem.limit(1).select((F.col("n_nationkey") + 1000).alias("n_nationkey"), "path")
    return ledger.upsert_row(rows, by_stem.unionByName(new), "n_nationkey")


def ledger_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records brought to the ledger's columns, flagged ones as audit rows of a run."""
    k = F.col("c_custkey")
    rows = _table(spark, sf_dir, "customer").select(k.cast("string").alias("image_id"), F.col("c_name").alias("species"), F.col("c_mktsegment").alias("band"), (k % 9 == 0).alias("is_unsafe"))
    full = ledger.ledger_rows(rows).join(rows.select("image_id", "is_unsafe"), "image_id")
    return ledger.drop_log(full, "is_unsafe", "nsfw", "score", "run1").select("image_id", "species", "band", "stage", "drop_reason", "url", "run_id")


def id_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct trimmed ids of a table, of a list and of a text file of ids."""
    some = _table(spark, sf_dir, "customer").where("c_custkey % 7 = 0").select(F.concat(F.lit(" "), F.col("c_custkey")).alias("i"))
    path = scratch_path(spark, "ids")
    sinks.write_ids(_table(spark, sf_dir, "customer").where("c_custkey % 10 = 0").select("c_custkey"), path)
    return ledger.id_set(some, ["x", " 7 ", ""], sources.read_ids(spark, path), spark=spark)


def quota_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quota rows as text, brought to types and bands, one band only and none above 7; how many they ask for."""
    k = F.col("p_partkey")
    raw = _table(spark, sf_dir, "part").select(k.cast("string").alias("Ranking"), F.col("p_name").alias("Name"), F.col("p_size").cast("string").alias("q_r_base"), _pick(k, "1-150 (a)", "band2", "501-800", "801-1025").alias("band"))
    return ledger.quota_total(sources.limit_quotas(sources.normalise_quotas(raw), "band3", limit=7))


def quota_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quota file written as CSV and read back with types, bands and order; the first rows of a preview."""
    k = F.col("n_nationkey")
    raw = _table(spark, sf_dir, "nation").select((k + 1).alias("Ranking"), F.col("n_name").alias("Name"), (k % 4).alias("q_r_base"), _pick(k, "band1", "151-500 x").alias("band"))
    path = scratch_path(spark, "quotas")
    sinks.export_csv(raw, path)
    return ledger.preview(sources.read_quotas(spark, path), 10, "band_label", "Ranking").select("Ranking", "Name", "q_r_base", "band_label")


def resolved_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file of each id: a preferred folder first, then the extension."""
    k = F.col("c_custkey")
    files = _table(spark, sf_dir, "customer").select(F.explode(F.array(F.concat(F.lit("/x/"), k, F.lit(".webp")), F.concat(F.lit("/y/"), k, F.lit(".jpg")), F.when(k % 3 == 0, F.concat(F.lit("/z/"), k, F.lit(".png"))))).alias("path")).where("path IS NOT NULL")
    ids = _table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.when(k % 10 == 0, F.concat(F.lit("no"), k)).otherwise(k.cast("string")).alias("image_id"))
    return sources.resolve_ids(ids, files, preferred=F.col("path").rlike("^/x/.*5|^/x/.*2"))


def mask_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    listing = _table(spark, sf_dir, "customer").select(F.explode(F.array(F.concat(F.lit("/m/"), k, F.lit("_mask.png")), F.when(k % 2 == 0, F.concat(F.lit("/m/"), k, F.lit(".jpg"))), F.when(k % 3 == 0, F.concat(F.lit("/m/"), k, F.lit(".PNG"))), F.concat(F.lit("/m/"), k, F.lit(".txt")))).alias("path")).where("path IS NOT NULL")
    return sources.masks_with_images(listing)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted line breaks, quotes, blanks, booleans and another delimiter survive; types are declared."""
    k = F.col("c_custkey")
    rows = _table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit('say "'), F.col("c_name"), F.lit('";\nnext')).alias("said"), F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("balance"), (k % 2 == 0).alias("even"))
    path = scratch_path(spark, "csv")
    sinks.export_csv(rows, path, sep=";")
    typed = sources.read_csv(spark, path, "c_custkey long, said string, balance double, even string", sep=";")
    return typed.select("c_custkey", F.length("said").alias("n"), F.contains("said", F.lit('"')).alias("quoted"), "balance", s.truthy(F.col("even")).alias("even"))


def text_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns as text with blanks kept, as a stream of records."""
    path = scratch_path(spark, "text-csv")
    rows = _table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("name"))
    sinks.export_csv(rows, path, single=True)
    return sources.read_text_csv(spark, path)


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written twice: the pointer names the second version, the first can still be read."""
    root = scratch_path(spark, "versions")
    rows = _table(spark, sf_dir, "nation").select("n_nationkey")
    sinks.write_version(rows, root, "one")
    sinks.write_version(rows.where("n_nationkey < 10"), root, "two")
    return sinks.read_version(spark, root).withColumn("version", F.lit("now")).unionByName(sinks.read_version(spark, root, "one").withColumn("version", F.lit("one")))


def audit_reruns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage that runs twice replaces its audit rows; another run adds to them."""
    path = scratch_path(spark, "audit")
    rows = _table(spark, sf_dir, "nation").select("n_nationkey")
    for run, part in (("r1", rows), ("r1", rows.where("n_nationkey < 5")), ("r2", rows.where("n_nationkey > 20"))):
        sinks.append_audit(part, path, "ocr", run)
    return spark.read.parquet(path).select("n_nationkey", "stage", "run_id")


def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts appended as JSON lines and read back with ragged keys, counted by status."""
    path = scratch_path(spark, "attempts")
    k = F.col("page_id")
    rows = _table(spark, sf_dir, "pages").select("url", _pick(k, "saved", "http_fail", "attempt").alias("status"), F.when(k % 2 == 0, F.lit(7)).alias("rank"))
    sinks.append_log(rows.where("page_id % 2 = 0"), path, NOW)
    sinks.append_log(rows.where("page_id % 2 = 1").drop("rank"), path, NOW)
    return sources.read_attempts(spark, path).groupBy("status", "ts").agg(F.count(F.lit(1)).alias("n"), F.count("rank").alias("ranked"))


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attempt log as a stream: the first sight of each URL of a group, committed by batch."""
    log, out, mark = (scratch_path(spark, x) for x in ("log", "seen", "mark"))
    k = F.col("event_id")
    rows = _table(spark, sf_dir, "events").select(F.col("event_type").alias("species"), F.concat(F.lit("http://a/"), F.col("user_id")).alias("url"), F.lit("attempt").alias("status"))
    sinks.append_log(rows, log, NOW)

    def commit(batch: DataFrame, number: int) -> None:
        batch.select("species", "url").write.mode("overwrite").parquet(f"{out}/batch={number}")

    attempts.run(attempts.first_seen(attempts.read_attempts(spark, log)), mark, commit).awaitTermination()
    return spark.read.parquet(out).select("species", "url")


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of attempts by ten-minute window and status; windows that are still open at the end stay inside."""
    log, out, mark = (scratch_path(spark, x) for x in ("log", "windows", "mark"))
    at = s.utc_text(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("event_id") * 7))
    rows = _table(spark, sf_dir, "events").select(F.col("event_type").alias("status"), at.alias("ts"), F.lit("u").alias("url"))
    rows.unionByName(rows.limit(1).withColumn("ts", F.lit("2033-01-01T00:00:00Z"))).write.json(log)
    counted = attempts.status_by_window(attempts.read_attempts(spark, log))
    query = counted.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema("window_start timestamp, status string, n long").parquet(out).select(F.unix_seconds("window_start").alias("window_start"), "status", "n")


def resumed_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work that stopped after some rows goes on with the others and stores results as it goes."""
    results = scratch_path(spark, "results")
    rows = _table(spark, sf_dir, "customer").select("c_custkey")

    def compute(df: DataFrame) -> DataFrame:
        return df.select("c_custkey", (F.col("c_custkey") * 3).alias("y"))

    compute(rows.where("c_custkey % 4 = 0")).withColumn("y", F.lit(-1).cast("long")).write.parquet(results)
    return sinks.checkpointed(rows, results, "c_custkey", compute, every=-(-rows.count() // 3))


def written_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload files by quarantine name: saved, already there, or missing; the listing tells their length."""
    root = scratch_path(spark, "files")
    k = F.col("n_nationkey")
    rows = _table(spark, sf_dir, "nation").select(packing.quarantine_name(_pick(k, "band1", "band2"), F.lower("n_name"), F.concat(F.lit("/a/b/"), k, F.lit(".bin"))).alias("name"), F.when(k % 5 != 0, F.encode("n_name", "UTF-8")).alias("content"), k.alias("k"))
    materialize(packing.write_files(rows.where("k % 2 = 0"), root, F.col("name"), F.col("content")), "first")
    status = materialize(packing.write_files(rows, root, F.col("name"), F.col("content"), replace=False), "second")
    there = sources.read_payloads(spark, root, content=False).select(F.regexp_extract("path", "(nsfw/.*)$", 1).alias("path"), F.col("length").alias("listed"))
    return status.join(there, "path", "left").select("path", "status", "length", "listed")


def packed_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples packed into three tar shards: how many each holds, and the members that were read back."""
    root = scratch_path(spark, "shards")
    k = F.col("c_custkey")
    rows = _table(spark, sf_dir, "customer").select(k.cast("string").alias("image_id"), F.lit("train").alias("split"), F.lit("u").alias("source_url"), F.lit("8x9").alias("image_size"), k.alias("ae_relevance"), k.alias("ae_aesthetic"), F.lit("mew, pikachu").alias("species"), F.lit("{}").alias("tags"), F.lit("").alias("phash"), F.col("c_name").alias("hybrid_caption"), F.concat(F.lit("/p/"), k, _pick(k, ".png", ".JPG", ".gif")).alias("path"), F.encode("c_name", "UTF-8").alias("content"))
    told = materialize(packing.write_shards(packing.sample_metadata(groups.assign_shards(rows, 3)), root, "train-%05d.tar", 3), "packed")

    files = sources.read_members(spark, root, "*.tar").where(F.regexp_like("name", F.lit(r"\.(png|jpg|txt)$")))
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("path"), F.concat_ws(":", "name", "length").alias("member"))
    return told.join(named, "path").select("path", "samples", "member")


def sample_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of samples: sizes parsed, names as a list, the hash only where there is one."""
    k = F.col("p_partkey")
    rows = _table(spark, sf_dir, "part").select(k.cast("string").alias("image_id"), F.lit("val").alias("split"), F.lit(None).cast("string").alias("source_url"), _pick(k, "10x20", "bad").alias("image_size"), F.col("p_retailprice").alias("ae_relevance"), F.lit(float("nan")).alias("ae_aesthetic"), F.replace("p_name", F.lit(" "), F.lit(", ")).alias("species"), F.lit(None).cast("string").alias("tags"), _pick(k, "ff", "", None).alias("phash"), F.lit(" c ").alias("hybrid_caption"), _pick(k, "a.webp", "b.tiff", "c").alias("path"))
    meta = F.parse_json("meta")
    out = packing.sample_metadata(rows)
    return out.select("image_id", "caption", "ext", F.try_variant_get(meta, "$.width", "int").alias("width"), F.try_variant_get(meta, "$.species_list[1]", "string").alias("second"), F.try_variant_get(meta, "$.phash", "string").alias("phash"), F.contains("meta", F.lit('"ae_aesthetic":null')).alias("blank_score"), F.try_variant_get(meta, "$.source_url", "string").alias("url"))


def paged_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of results until a query has no more, asked in lanes."""
    names = [r["n_name"] for r in _table(spark, sf_dir, "nation").collect()]

    def fetch(query: str, page: int) -> list[dict]:
        return [{"url": f"http://x/{query}/{page}/{i}", "title": query.lower()} for i in range(3)] if page < len(query) % 4 else []

    return search.search(spark, fetch, names, pages=2)


def fetched_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only images count; failures of the client are rows without content."""

    def build() -> Callable:
        def get(url: str):
            n = len(url)
            if n % 3 == 0:
                raise OSError("no route")
            return url.encode(), "Image/PNG" if n % 3 == 1 else "text/html"

        return get

    rows = search.fetch_payloads(_table(spark, sf_dir, "pages").select("page_id", "url"), build)
    return rows.select("page_id", F.md5("content").alias("digest"), "content_type")


def collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection run: searched, fetched, validated, the first within each quota kept; what its log says."""
    quotas = _table(spark, sf_dir, "region").select((F.col("r_regionkey") + 1).alias("Ranking"), F.col("r_name").alias("Name"), F.col("r_regionkey").cast("int").alias("q_r_base"), F.lit("band1").alias("band"))

    def fetch(query: str, page: int) -> list[dict]:
        name = query.removesuffix(" art")
        return [{"url": f"http://h.org/{name}/{page}/{i}.png", "title": name} for i in range(3)] if page < 2 else []

    def build() -> Callable:
        def get(url: str):
            side = 64 if url.endswith("0.png") else 128
            return rasters.encode_png(np.full((side, 128), len(url) * 7 + int(url[-7]) * 5 + int(url[-5]), np.uint8)), "image/png"

        return get

    kept, log, _ = collect(spark, sources.normalise_quotas(quotas), fetch, build, "art", "run", NOW, pages=3, rate=None)
    per = kept.groupBy("species").agg(F.count(F.lit(1)).alias("kept"))
    return log.groupBy("species").pivot("status", ["attempt", "invalid_or_corrupt", "saved"]).agg(F.count(F.lit(1))).join(per, "species", "left").select("species", "attempt", "invalid_or_corrupt", "saved", F.coalesce("kept", F.lit(0)).alias("kept"))


def _scorer() -> Callable:
    def build() -> Callable:
        def call(row):
            digest = hashlib.md5(row["image_id"].encode()).digest()
            if digest[2] % 4 == 0 and row["attempt"] == 1:
                return None
            return {"reply": "no" if digest[3] % 5 == 0 else json.dumps({"relevance": digest[0] % 101, "aesthetic": digest[1] % 101})}

        return call

    return build()


def scored_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scoring plan: unflagged rows without a score are asked, up to three times; replies that do not parse are left."""
    k = F.col("c_custkey")
    rows = _table(spark, sf_dir, "customer").select(k.alias("row_id"), k.cast("string").alias("image_id"), (k % 6 == 0).alias("is_unsafe"), F.when(k % 5 == 0, F.lit(1)).alias("ae_relevance"), F.when(k % 5 == 0, F.lit(2)).alias("ae_aesthetic"), F.when(k % 7 != 0, F.concat(F.lit("/p/"), k)).alias("path_resized"))
    payloads = rows.select(F.col("path_resized").alias("path"), F.lit(b"x").alias("content")).where("path IS NOT NULL")
    return stages.score(rows, payloads, _scorer).select("row_id", "ae_relevance", "ae_aesthetic")


def _bars(k: Column) -> Column:
    """A PNG for each key: white, with the left eighths of its number in black."""

    @F.pandas_udf("binary")
    def draw(key):
        def one(n):
            p = np.full((128, 128), 255, np.uint8)
            p[:, : 16 * (int(n) % 8)] = 0
            return rasters.encode_png(p)

        return key.map(one)

    return draw(k)


def _pictures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("n_nationkey")
    rows = _table(spark, sf_dir, "nation").select(k.cast("long").alias("row_id"), k.cast("string").alias("image_id"), (k % 9 == 0).alias("is_unsafe"), F.concat(F.lit("/r/"), k).alias("path_raw"), F.concat(F.lit("/r/"), k).alias("path"))
    content = F.when(k % 8 == 7, F.substring(_bars(k), 1, 60)).otherwise(_bars(k))  # some are cut off
    return rows, materialize(_table(spark, sf_dir, "nation").where("n_nationkey <> 20").select(F.concat(F.lit("/r/"), k).alias("path"), content.alias("content")), "pictures")


def hashed_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perceptual hashes of the pictures: equal ones agree, cut-off and missing ones have none."""
    rows, payloads = _pictures(spark, sf_dir)
    out = stages.phash(rows.withColumns({"path_resized": F.col("path_raw"), "out_path": F.lit(None).cast("string")}), payloads)
    firsts = out.where("phash64 IS NOT NULL").groupBy("phash64").agg(F.min("row_id").alias("first"))
    return out.join(firsts, "phash64", "left").select("row_id", F.col("phash64").isNotNull().alias("hashed"), "first")


def identified_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format, size and validity; a file that is cut off is no image."""
    _, payloads = _pictures(spark, sf_dir)
    return media.identified(payloads).select("path", "fmt", "w", "h", "valid")


def flagged_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagging plan with a model that tells how much of a picture is black; its audit rows."""
    rows, payloads = _pictures(spark, sf_dir)

    def build() -> Callable:
        return lambda row: {"scores": {"dark": float((rasters.decode_png(row["content"]) == 0).mean())}}

    out, audit = stages.flag_unsafe(rows.drop("is_unsafe"), payloads, build, "r1", threshold=0.5, tags=("dark",))
    return out.join(audit.select("image_id", "nsfw_score", "threshold"), "image_id", "left").select("row_id", "is_unsafe", "is_unsafe_score", "is_unsafe_tags", "nsfw_score", "threshold")


def unflagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The withdrawal plan: hashes in free text clear the flag and score of their rows."""
    h = F.md5(F.col("c_custkey").cast("string"))
    rows = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"), h.alias("image_id"), (F.col("c_custkey") % 2 == 0).alias("is_unsafe"), F.lit(0.7).alias("is_unsafe_score"))
    drops = rows.where("is_unsafe").select("image_id", F.lit("nsfw").alias("stage"), F.lit("").alias("path_raw"))
    tokens = rows.where("row_id % 6 = 0").select(F.concat(F.lit("see /x/"), F.upper("image_id"), F.lit(".png")).alias("t"))
    out, left = stages.unflag_unsafe(rows, drops, tokens)
    return out.join(left.select("image_id", F.lit(True).alias("logged")), "image_id", "left").select("row_id", "is_unsafe", "is_unsafe_score", F.coalesce("logged", F.lit(False)).alias("logged"))


def resized_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resize plan: status and size of each row, counted."""
    rows, payloads = _pictures(spark, sf_dir)
    _, counts = stages.resize(rows, payloads, "/r", scratch_path(spark, "resized"), F.lit(None).cast("string"), encoder=lambda pixels, ext: rasters.encode_png(pixels))
    return counts


def _find_bars() -> Callable:
    def detect(pixels: np.ndarray) -> list:
        """The box around all black pixels, if there are any."""
        ys, xs = np.nonzero(pixels[:, :, 0] < 128)
        if not len(xs):
            return []
        x0, x1, y0, y1 = xs.min(), xs.max() + 1, ys.min(), ys.max() + 1
        return [([[x0, y0], [x1, y0], [x1, y1], [x0, y1]], ("text", 0.9))]

    return detect


def detected_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detection plan on enlarged pictures: boxes in original coordinates, pixels of the mask, painted pixels."""
    rows, payloads = _pictures(spark, sf_dir)
    out, hits = stages.detect_text(rows, payloads, _find_bars, short_side=256, grow=0, reject_round=False)
    painted = stages.inpaint_text(hits, payloads, lambda pixels, mask: np.where(mask[..., None] > 0, 200, pixels).astype(np.uint8))

    @F.pandas_udf("long")
    def marked(blobs):
        return blobs.map(lambda b: int((rasters.decode_png(bytes(b)) == 255).sum()))

    @F.pandas_udf("long")
    def dark(blobs):
        return blobs.map(lambda b: int((rasters.decode_png(bytes(b))[:, :, 0] == 0).sum()))

    found = hits.join(painted.select("row_id", dark("content").alias("dark")), "row_id").select("row_id", F.round(F.col("boxes")[0]["area"]).cast("long").alias("area"), marked("mask").alias("marked"), "dark", F.get_json_object("document", "$.width").alias("width"))
    return out.select("row_id", "has_ocr").join(found, "row_id", "left")


def rotated_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes found on pictures turned by right angles come back to the same place; recognition rechecks them."""
    _, payloads = _pictures(spark, sf_dir)
    found = detect_boxes(payloads, _find_bars, rotations=(0, 90, 180, 270), short_side=0, recognise=lambda: lambda crop: float((crop[:, :, 0] == 0).mean()))
    one = found.select("path", F.posexplode("boxes").alias("n", "b")).select("path", "n", F.transform("b.points", lambda p: p[0]).alias("x"), F.transform("b.points", lambda p: p[1]).alias("y"), "b.rec")
    bar = 16 * (F.regexp_extract("path", "([0-9]+)$", 1).cast("int") % 8)
    sides = ((F.array_min("x"), 0), (F.array_max("x"), bar), (F.array_min("y"), 0), (F.array_max("y"), 128))
    near = F.lit(True)
    for side, want in sides:
        near = near & (F.abs(side - want) <= 1.01)
    return one.select("path", "n", near.alias("near"), (F.col("rec") > 0.5).alias("read"))


def recognised_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recheck of boxes by their recognition; a row with a box left is a hit, a miss clears no earlier one."""
    w = F.col("l_quantity")
    zero = F.lit(0.0)
    corners = F.array(F.array(zero, zero), F.array(w, zero), F.array(w, F.lit(10.0)), F.array(zero, F.lit(10.0)))
    boxes = F.array(F.struct(corners.alias("points"), F.lit(0.9).alias("conf"), (F.col("l_discount") * 10).alias("rec")))
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", boxes.alias("boxes"), (F.col("l_linenumber") == 3).alias("has_ocr"))
    return media.text_boxes(rows, recheck=0.45, reject_round=False).select("l_orderkey", "l_linenumber", "has_ocr", F.size("boxes").alias("n"))


def captioned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captioning plan: blank captions are asked for, replies give a sentence and tags."""
    k = F.col("c_custkey")
    rows = _table(spark, sf_dir, "customer").select(k.alias("row_id"), k.cast("string").alias("image_id"), F.concat(F.lit("/p/"), k).alias("path"), F.when(k % 3 == 0, F.lit("old")).alias("caption"), F.lit(None).cast("string").alias("tags"))
    payloads = rows.select("path", F.lit(b"x").alias("content"))

    def build() -> Callable:
        def call(row):
            n = int(row["image_id"])
            return {"reply": "?" if n % 5 == 0 else json.dumps({"sentence": f"a cat {n}. More", "tags": {"pose": ["On Top"]}})}

        return call

    out = stages.caption(rows, payloads, build)
    return out.select("row_id", "caption", F.get_json_object("tags", "$.pose[0]").alias("pose"))


def recap_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to caption again: four columns, the old caption and tags blanked."""
    return captions.recap_rows(_table(spark, sf_dir, "customer").where("c_custkey % 8 = 0").select(F.col("c_name").alias("path"), F.col("c_custkey").cast("string").alias("image_id"), F.lit("old").alias("caption"), F.lit(1).alias("more")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries of this module by name."""
    imported = {"collect", "detect_boxes", "materialize", "polygon", "scratch_path"}
    return {n: f for n, f in globals().items() if callable(f) and getattr(f, "__module__", "") == __name__ and not n.startswith("_") and n not in imported | {"queries"}}
