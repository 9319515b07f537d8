"""Sources, sinks, streams and whole plans on small files."""

import io
import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.functions import rasters
from siltstone.operators import groups, rank
from siltstone.plans import curate
from siltstone.sinks import payloads, tables as out
from siltstone.sources import search, tables
from siltstone.streaming import attempts


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted"\nline', True, None), (2, "", None, [1, None])], "i int, t string, b boolean, l array<int>")
    out.export_csv(df, f"{tmp_path}/c", single=True)
    back = tables.read_text_csv(spark, f"{tmp_path}/c").orderBy("i").collect()
    assert [tuple(r) for r in back] == [("1", 'a "quoted"\nline', "TRUE", ""), ("2", "", "", "[1,null]")]
    typed = tables.read_csv(spark, f"{tmp_path}/c", "i int, t string, b string, l string").orderBy("i").collect()
    assert typed[1]["t"] is None and typed[0]["i"] == 1


def test_quotas(spark, tmp_path):
    (tmp_path / "q.csv").write_text("Ranking,Name,q_r_base,band\n160,B,30,151-500 (x)\n7,Mr. Mime,50,1-150\n")
    q = tables.read_quotas(spark, f"{tmp_path}/q.csv")
    assert [(r["Ranking"], r["band_label"]) for r in q.collect()] == [(7, "band1"), (160, "band2")]
    assert [r["q_r_base"] for r in tables.limit_quotas(q, "all", limit=40).collect()] == [40, 30]
    assert search.requests_for(q, "art").first()["query"] == "Mr. Mime art"
    (tmp_path / "bad.csv").write_text("Ranking,Name\n1,a\n")
    with pytest.raises(ValueError, match="missing columns"):
        tables.read_quotas(spark, f"{tmp_path}/bad.csv")


def test_files(spark, tmp_path):
    for name in ("band1/x/a.webp", "band1/x/a.png", "other/a.jpg", "b_mask.png", "b.jpg", "b.webp", "c_mask.png"):
        p = tmp_path / "f" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x")
    listing = tables.read_payloads(spark, f"{tmp_path}/f", content=False)
    ids = spark.createDataFrame([("a",), ("zz",)], "image_id string")
    got = {r["image_id"]: r["path"] for r in tables.resolve_ids(ids, listing, preferred=F.col("path").contains("/band")).collect()}
    assert got["a"].endswith("band1/x/a.png") and got["zz"] is None
    pairs = tables.masks_with_images(listing).collect()
    assert [(r["mask"].rsplit("/", 1)[1], r["image"].rsplit("/", 1)[1]) for r in pairs] == [("b_mask.png", "b.jpg")]
    (tmp_path / "ids.txt").write_text("b\n a \n\nb\n")
    assert [r["id"] for r in tables.read_ids(spark, f"{tmp_path}/ids.txt").collect()] == ["a", "b"]


def test_search_and_fetch(spark, tmp_path):
    (tmp_path / "cat").mkdir()
    for page, urls in enumerate((["u1", "u2"], ["u2", "bad"], [])):
        (tmp_path / "cat" / f"{page}.json").write_text(json.dumps([{"url": u, "title": "t"} for u in urls]))
    root = str(tmp_path)
    fetch = search.fixture_pages(root)
    found = search.search(spark, fetch, ["cat", "dog"], rate=1000)
    assert [(r["page"], r["url"]) for r in found.orderBy("page", "position").collect()] == [(0, "u1"), (0, "u2"), (1, "u2"), (1, "bad")]

    def build():
        def get(url):
            if url == "bad":
                raise OSError
            return (b"img" + url.encode(), "Image/PNG" if url == "u1" else "text/html")

        return get

    got = {r["url"]: r["content_type"] for r in search.fetch_payloads(found.dropDuplicates(["url"]), build).collect()}
    assert got == {"u1": "image/png", "u2": None, "bad": None}


def test_collect(spark):
    from siltstone.plans.collect import collect

    images = {f"http://h/{i}.png": rasters.encode_png(np.full((130, 130, 3), i % 4, np.uint8)) for i in range(6)} | {"http://h/small.png": rasters.encode_png(np.zeros((5, 5, 3), np.uint8))}
    pages = {"Cat art": [["http://h/0.png", "http://h/small.png", "http://h/0.png"], ["http://h/4.png", "http://h/1.png", "http://h/2.png", "http://gone"]], "Dog art": [["http://h/3.png"]]}

    def fetch(query, page):
        return [{"url": u, "title": "t"} for u in pages[query][page]] if page < len(pages[query]) else []

    def client():
        return lambda url: (images[url], "image/png")

    quotas = tables.normalise_quotas(spark.createDataFrame([("1", "Cat", "2", "1-150"), ("2", "Dog", "1", "band1")], "Ranking string, Name string, q_r_base string, band string"))
    import hashlib

    present = spark.createDataFrame([("Dog", hashlib.md5(images["http://h/3.png"]).hexdigest())], "species string, image_id string")
    kept, log, files = collect(spark, quotas, fetch, client, "art", "run", "2024-01-01T00:00:00Z", present, rate=None)
    assert sorted((r["species"], r["source_url"], r["w"]) for r in kept.collect()) == [("Cat", "http://h/0.png", 130), ("Cat", "http://h/1.png", 130)]
    status = {(r["url"], r["status"]) for r in log.where("status <> 'attempt'").collect()}
    assert status == {("http://h/0.png", "saved"), ("http://h/small.png", "invalid_or_corrupt"), ("http://h/4.png", "duplicate_existing"), ("http://h/1.png", "saved"), ("http://h/2.png", "saved"), ("http://gone", "http_fail"), ("http://h/3.png", "duplicate_existing")}
    assert log.where("status = 'attempt'").count() == 7 and all(r["path_raw"].startswith("data_raw/band1/0001_Cat/imgs/") for r in files.collect())


def test_versions_logs_and_resume(spark, tmp_path):
    root = f"{tmp_path}/v"
    out.write_version(spark.range(3), root, "r1")
    current = out.read_version(spark, root)
    out.write_version(current.where("id > 0"), root, "r2")
    assert out.read_version(spark, root).count() == 2 and out.read_version(spark, root, "r1").count() == 3
    out.append_log(spark.createDataFrame([("a", None)], "url string, ts string"), f"{tmp_path}/log")
    out.append_log(spark.createDataFrame([("b", "2020-01-01T00:00:00Z")], "url string, ts string"), f"{tmp_path}/log")
    assert tables.read_attempts(spark, f"{tmp_path}/log").where("ts IS NOT NULL").count() == 2
    for _ in range(2):
        out.append_audit(spark.createDataFrame([("x",)], "image_id string"), f"{tmp_path}/audit", "nsfw", "run1")
    assert spark.read.parquet(f"{tmp_path}/audit").count() == 1
    seen = []

    def compute(part):
        seen.append(part.count())
        if len(seen) == 3:
            raise RuntimeError("stopped")
        return part.withColumn("score", F.lit(1))

    with pytest.raises(RuntimeError):
        out.checkpointed(spark.range(40), f"{tmp_path}/res", "id", compute, every=5)
    before = sum(seen[:2])
    done = out.checkpointed(spark.range(40), f"{tmp_path}/res", "id", lambda p: p.withColumn("score", F.lit(2)), every=5)
    assert done.count() == 40 and done.where("score = 1").count() == before


def test_write_files(spark, tmp_path):
    df = spark.createDataFrame([("n/a.bin", b"1"), ("n/b.bin", None)], "name string, content binary")
    first = {r["path"]: r["status"] for r in payloads.write_files(df, f"{tmp_path}/w", F.col("name"), F.col("content"), replace=False).collect()}
    again = {r["path"]: r["status"] for r in payloads.write_files(df, f"{tmp_path}/w", F.col("name"), F.col("content"), replace=False).collect()}
    assert first == {"n/a.bin": "saved", "n/b.bin": "missing"} and again["n/a.bin"] == "duplicate_existing"
    assert (tmp_path / "w/n/a.bin").read_bytes() == b"1" and len(list((tmp_path / "w/n").iterdir())) == 1


def ledger_rows(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        h = f"{i // 2:04x}{0:012x}" if i < 20 else f"{1000 + i:04x}{0:012x}"
        rows.append((i, f"img{i}", f"http://x/{i}", i % 7 == 0, h, int(rng.integers(50, 101)), int(rng.integers(50, 101)), 100, 200, f"/p/{i}.png", None, "2020"))
    return spark.createDataFrame(rows, "row_id long, image_id string, source_url string, is_unsafe boolean, phash64 string, ae_relevance int, ae_aesthetic int, new_w int, new_h int, path_resized string, out_path string, ts string")


def test_curate(spark):
    ledger = ledger_rows(spark)
    files = ledger.where("row_id <> 30").select(F.col("path_resized").alias("path"))
    base, audit, missing = curate.curate(ledger, files, "now", curate.Curation(top_n=25))
    kept = {r["image_id"] for r in audit.where("kept").collect()}
    removed = {r["image_id"] for r in audit.where("NOT kept").collect()}
    rows = base.collect()
    ids = {r["image_id"] for r in rows}
    assert kept and removed and not kept & removed and not ids & removed
    assert base.columns == ["path", "source_url", "image_size", "ae_relevance", "ae_aesthetic", "image_id", "phash"]
    assert all(r["ae_relevance"] >= 60 and r["ae_aesthetic"] >= 60 and int(r["image_id"][3:]) % 7 for r in rows) and len(rows) + missing.count() <= 25


def test_sources_of_resize(spark):
    rows = spark.createDataFrame([("a", True, "raw/a.jpg", False), ("b", False, "raw/b.jpg", False), ("c", True, "", False), ("d", False, "raw/a.jpg", True)], "image_id string, has_ocr boolean, path_raw string, is_unsafe boolean")
    files = spark.createDataFrame([("/paint/a.png",), ("/root/raw/a.jpg",), ("/root/raw/b.jpg",)], "path string")
    chosen = rank.choose_source(rows, files, "/root", F.concat(F.lit("/paint/"), "image_id", F.lit(".png")))
    planned = rank.resize_plan(chosen, F.lit(800), F.lit(600))
    got = {r["image_id"]: (r["source_used"], r["status"], r["new_w"], r["scale"], r["ar_before"]) for r in planned.collect()}
    assert got == {"a": ("inpainted", "ok", 1365, 1.706667, 1.333333), "b": ("raw", "ok", 1365, 1.706667, 1.333333), "c": (None, "missing", None, None, None), "d": ("raw", "skipped_nsfw", None, None, None)}


def test_package(spark, tmp_path):
    rows = [(f"id{i}", f"/p/{i}.PNG", json.dumps({"Pokémon": [f"s{i % 4}"]}), "http://x", "64x48", 90, 80, "", f"cap {i}") for i in range(20)]
    base = spark.createDataFrame(rows, "image_id string, path string, tags string, source_url string, image_size string, ae_relevance int, ae_aesthetic int, phash string, hybrid_caption string")
    files = spark.createDataFrame([(f"/p/{i}.PNG", rasters.encode_png(np.full((2, 2, 3), i, np.uint8))) for i in range(19)], "path string, content binary")
    shards, stats = curate.package(base, files, f"{tmp_path}/s", train_shards=3)
    stats = json.loads(stats)
    names, counts = [], {}
    for r in shards.collect():
        with tarfile.open(f"{tmp_path}/s/{r['path']}") as tar:
            members = tar.getnames()
            meta = json.load(tar.extractfile(members[2]))
            assert tar.getmembers()[0].mtime == 0 and len(members) == 3 * r["samples"]
        assert meta["width"] == 64 and meta["species_list"] == [meta["species"]] and "phash" not in meta
        names += [m for m in members if m.endswith(".png")]
        counts[r["path"].split("/")[0]] = counts.get(r["path"].split("/")[0], 0) + r["samples"]
    assert len(names) == len(set(names)) == 19 == stats["total"]
    assert counts == {"train": stats["train"], "val": stats["val"]} and 0 < stats["val"] <= 8
    assert stats["ids"]["val"]["count"] == stats["val"]


def test_unique_by_id_prefers_train(spark):
    df = spark.createDataFrame([("a", "val", "p1"), ("a", "train", "p2"), ("b", "val", "p3")], "image_id string, split string, path string")
    assert {r["image_id"]: r["split"] for r in groups.unique_by_id(df).collect()} == {"a": "train", "b": "val"}


def test_caption_plan(spark):
    base = spark.createDataFrame([("a", "One.", '{"Pokémon": ["mew"]}'), ("b", "Two.", "{}")], "image_id string, caption string, tags string")
    fixed = spark.createDataFrame([("a", "Better.", "")], "image_id string, caption string, tags string")
    good, again = curate.caption_base(base, fixed)
    assert [r["hybrid_caption"] for r in good.collect()] == ["Better. | mew"] and [r["image_id"] for r in again.collect()] == ["b"]


def test_stream_equals_batch(spark, tmp_path):
    rows = [{"ts": f"2024-01-01T00:{m:02d}:00Z", "status": "attempt", "url": u, "species": "g"} for m, u in ((0, "a"), (1, "b"), (2, "a"), (3, ""), (4, "c"), (5, "b"))]
    (tmp_path / "log").mkdir()
    (tmp_path / "log/1.json").write_text("\n".join(map(json.dumps, rows)))
    stream = attempts.first_seen(attempts.read_attempts(spark, f"{tmp_path}/log"))
    commits = []

    def commit(batch, batch_id):
        batch.select("url").write.mode("overwrite").parquet(f"{tmp_path}/out/batch={batch_id}")
        commits.append(batch_id)

    attempts.run(stream, f"{tmp_path}/cp", commit).awaitTermination()
    assert sorted(r["url"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b", "c"]
    n = len(commits)
    (tmp_path / "log/2.json").write_text(json.dumps(rows[0]))
    attempts.run(stream, f"{tmp_path}/cp", commit).awaitTermination()
    assert len(commits) > n and sorted(r["url"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b", "c"]


def test_packed_shards_are_streams(spark, tmp_path):
    """No archive is held as one value, and blocks are those of an archive that keeps a list of its members."""
    from siltstone import stage_queries

    files = [(f"{i}.txt", b"x" * (i * 300)) for i in range(40)]
    want = io.BytesIO()
    with tarfile.open(fileobj=want, mode="w|", format=tarfile.USTAR_FORMAT) as tar:
        for name, data in files:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    blocks = b"".join(payloads.tar_entry(*f) for f in files)
    (tmp_path / "a.tar").write_bytes(blocks + payloads.tar_end(len(blocks)))
    assert (tmp_path / "a.tar").read_bytes() == want.getvalue()
    (tmp_path / "empty.tar").write_bytes(payloads.tar_end(0))
    assert {(r["name"], r["length"]) for r in tables.read_members(spark, str(tmp_path)).collect()} == {(n, len(d)) for n, d in files}
    most = "spark.sql.sources.binaryFile.maxLength"
    before = spark.conf.get(most)
    spark.conf.set(most, "1000")
    try:
        got = stage_queries.packed_shards(spark, "/root/testdata/sf0.001")
        assert got.count() == 2 * spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()
    finally:
        spark.conf.set(most, before)
