"""Operators on hand-made edge rows, with expected values worked out by hand, and invariants of the larger ones."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.functions import documents as d
from siltstone.functions import polygons, rasters
from siltstone.functions import scalars as s
from siltstone.operators import captions, dedup, groups, ledger, media, rank


def apply(spark, expression, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_truthy_and_casts(spark):
    assert apply(spark, s.truthy, [" TRUE ", "1", "t", "1.0", "false", "", None]) == [True, True, True, True, False, False, False]
    assert apply(spark, lambda x: s.int_or(x), ["7.9", "x", None]) == [7, 0, 0]
    assert apply(spark, lambda x: s.double_or(x, -1.0), ["0.5", "x", None]) == [0.5, -1.0, -1.0]


def test_names_and_paths(spark):
    assert apply(spark, s.band_of, ["1-150 (x)", "band3"]) == ["band1", "band3"]
    with pytest.raises(Exception, match="unknown band"):
        apply(spark, s.band_of, ["zzz"])
    assert apply(spark, lambda x: s.folder_name(F.lit(7), x), ["Mr. Mime"]) == ["0007_Mr_Mime"]
    assert apply(spark, s.domain, ["https://A.Example.org:8080/x", None, "::"]) == ["a.example.org:8080", "", ""]
    assert apply(spark, s.extension, ["http://x/a.PNG?y", "http://x/a.gif", None]) == [".png", ".jpg", ".jpg"]
    assert apply(spark, lambda x: s.extension(x, F.lit("WEBP")), ["http://x/a.gif"]) == [".webp"]
    assert apply(spark, s.md5_in, ["see " + "A" * 32 + ".", "none"]) == ["a" * 32, None]
    assert apply(spark, lambda x: s.path_part(x, 3), ["/r/band1/0001_x/imgs/a.png", "a"]) == ["0001_x", None]
    assert apply(spark, s.stem_of, ["/a/b.c.png", "x"]) == ["b.c", "x"]
    assert [tuple(x) for x in apply(spark, s.parse_size, ["1024x768", "0x5", "ax5", ""])] == [(1024, 768), (None, None), (None, None), (None, None)]


def test_resize_policy(spark):
    df = spark.createDataFrame([(800, 600), (1024, 1024), (2048, 4096), (3000, 3000), (4096, 4096), (5000, 6000), (1200, 5000)], "w int, h int")
    got = [tuple(r["t"]) for r in df.select(s.target_size(F.col("w"), F.col("h")).alias("t")).collect()]
    want = [(1365, 1024, "BICUBIC", "upscale_to_1024"), (1024, 1024, "KEEP", "keep"), (2048, 4096, "KEEP", "keep"), (2048, 2048, "BICUBIC", "downscale_to_2048"), (2048, 2048, "BICUBIC", "downscale_to_2048"), (2048, 2458, "AREA", "downscale_to_2048"), (2048, 8533, "BICUBIC", "downscale_to_2048")]
    assert [(a, b, k, act) for a, b, _, k, act in got] == want
    strict = df.where("w = 1200").select(s.target_size(F.col("w"), F.col("h"), strict=True).alias("t")).first()["t"]
    assert (strict["new_w"], strict["new_h"]) == (983, 4096)


def test_scores(spark):
    df = spark.createDataFrame([(60.0, 80.0), (80.0, 80.0), (100.0, 80.0)], "r double, a double")
    assert [r[0] for r in df.select(s.effective_score(F.col("r"), F.col("a"))).collect()] == pytest.approx([68.0, 74.0, 80.0])
    gate = spark.createDataFrame([(60.0, 60.0), (59.9, 99.0), (None, 99.0), (float("nan"), 99.0)], "ae_relevance double, ae_aesthetic double")
    assert rank.gate(gate).count() == 1
    replies = ['{"r":82,"a":76}', '```json\n{"r":82,"a":76}\n```', '{"relevance":90,"r":10,"a":5}', '{"relevance":null,"r":10,"a":5}', '{"r":"86.5","a":"87.5"}', '{"r":140,"a":-3}', '{"r":true,"a":50}', '{"r":"abc","a":1}', '{"r":1} {"a":2}', "none", None]
    got = [None if x is None else tuple(x) for x in apply(spark, d.parse_scores, replies)]
    assert got == [(82, 76), (82, 76), (90, 5), None, (86, 88), (100, 0), (1, 50), None, None, None, None]


def test_sentence(spark):
    long = " ".join(f"w{i}" for i in range(30))
    assert apply(spark, s.sentence, ["", '"A cat sits. Then runs."', long, "`x  y`"]) == [".", "A cat sits.", " ".join(long.split()[:28]) + ".", "x y."]


def test_tag_documents(spark):
    assert apply(spark, lambda x: d.snake_list(F.from_json(x, "array<string>")), ['["Chef Hat","chef-hat","",null,null]']) == [["chef_hat", None, None]]
    assert apply(spark, s.snake, ["Flabébé--X"]) == ["flab_b_x"]
    raw = json.dumps({"Pokémon": ["Mr. Mime", "Pikachu", "Pikachu"], "form": ["mega_x"], "shiny": True, "art_style": ["anime", "oil"], "composition": ["bust", "no", "macro", "profile_view"], "subject_count": 4, "pose": "sitting", "outfit": ["Red Hat", "red hat"]})
    t = apply(spark, lambda x: d.coerce_tags(d.parse(x)), [raw, "[]", "bad"])
    assert t[1] is None and t[2] is None
    t = t[0]
    assert (t["names"], t["form"]) == (["mr_mime", "pikachu"], ["mega_x", None])
    assert (t["shiny_presence"], t["art_style"], t["composition"], t["subject_count"], t["pose"], t["outfit"], t["trimmed"]) == (True, ["anime"], ["bust", "macro"], "single", [], ["red_hat"], False)
    caption = apply(spark, d.parse_caption, ["`" + json.dumps({"sentence": "A b. C.", "tags": {"Pokémon": "Mew"}}) + "`", "no"])
    assert caption[0]["sentence"] == "A b." and caption[0]["tags"]["names"] == ["mew"] and caption[1] is None


def test_compose(spark):
    tags = [
        json.dumps({"Pokémon": ["charizard", "pikachu"], "form": ["mega_x"], "shiny_presence": True, "shiny_pokemon": ["pikachu"], "art_style": ["anime", "anime"], "subject_count": "multiple"}),
        json.dumps({"Pokémon": "urshifu", "form": "rapid_strike"}), json.dumps({"pokemon": ["arcanine"], "form": ["hisuian"]}), '{""art_style"": ""anime""},', None, "{}",
    ]
    df = spark.createDataFrame([(i, "S.", t) for i, t in enumerate(tags)] + [(9, "", '{"art_style":"anime"}')], "i int, caption string, tags string")
    got = {r["i"]: r["hybrid_caption"] for r in captions.hybrid_captions(df).collect()}
    assert got == {0: "S. | mega charizard x, shiny pikachu, anime, multiple", 1: "S. | rapid_strike urshifu", 2: "S. | hisui arcanine", 3: "S. | anime", 4: "S.", 5: "S.", 9: " | anime"}


def test_screen_and_upsert(spark):
    tags = [None, "{bad", '{"Pokémon": []}', '{"Pokémon": [" "]}', '{"Pokémon": "Mew"}']
    kept, flagged = captions.screen(spark.createDataFrame(list(enumerate(tags)), "i int, tags string"))
    assert [r["i"] for r in kept.collect()] == [4] and flagged.count() == 4
    assert captions.recap_rows(flagged).columns == ["path", "image_id", "caption", "tags"]
    base = spark.createDataFrame([("a", "old", "t"), ("b", "old", "t"), ("c", "", "t")], "image_id string, caption string, tags string")
    fresh = spark.createDataFrame([("a", "new", " "), ("a", "", "x"), ("c", "new", None)], "image_id string, caption string, tags string")
    got = {r["image_id"]: (r["caption"], r["tags"]) for r in captions.upsert(base, fresh).collect()}
    assert got == {"a": ("new", "x"), "b": ("old", "t"), "c": ("new", "t")}
    assert {r["image_id"]: r["caption"] for r in captions.upsert(base, fresh, only_missing=True).collect()} == {"a": "old", "b": "old", "c": "new"}


def test_flags(spark):
    rows = spark.createDataFrame([(1, {"a": 0.2, "b": 0.7, "c": 0.0}), (2, {}), (3, None)], "i int, m map<string,double>")
    got = {r["i"]: (r["is_unsafe_score"], r["is_unsafe_tags"], r["is_unsafe"]) for r in ledger.flag_by_score(rows, "m", 0.5, ("a", "b", "c")).collect()}
    assert got == {1: (0.7, "b:0.700;a:0.200", True), 2: (0.0, "", False), 3: (0.0, "", False)}
    base = spark.createDataFrame([("A", "TRUE"), ("b", None), (None, "TRUE")], "id string, f string")
    marked = {r["id"]: r["f"] for r in ledger.mark_by_keys(base, spark.createDataFrame([("b",), ("b",)], "id string"), "id", "f").collect()}
    assert marked == {"A": True, "b": True, None: True}
    cleared = {r["id"]: r["f"] for r in ledger.unflag_by_keys(base, spark.createDataFrame([("a",)], "id string"), "id", "f").collect()}
    assert cleared == {"A": False, "b": False, None: True}
    h = "0123456789abcdef" * 2
    drops = spark.createDataFrame([(h, "x", "nsfw"), ("", f"/r/z{h}.png", "nsfw"), (h, "", "ocr"), ("q", "", "nsfw")], "image_id string, path_raw string, stage string")
    left, gone = ledger.withdraw_drops(drops, spark.createDataFrame([(h,)], "id string"), "nsfw")
    assert left.count() == 2 and gone.count() == 2
    assert ledger.id_set(spark.createDataFrame([(" b",), ("a",)], "v string"), ["a ", ""], spark=spark).collect() == [("a",), ("b",)]
    with pytest.raises(ValueError, match="missing columns: zz"):
        ledger.require_columns(base, "id", "zz")
    log = ledger.drop_log(spark.createDataFrame([("i", True), ("j", False)], "image_id string, bad boolean"), "bad", "nsfw", "score", "run1").collect()
    assert [(r["image_id"], r["stage"], r["run_id"]) for r in log] == [("i", "nsfw", "run1")]


def near(spark, rows, **how):
    df = spark.createDataFrame([(i, f"img{i}", h, a, w, ts, False) for i, (h, a, w, ts) in enumerate(rows)], "row_id long, image_id string, phash64 string, ae_aesthetic string, w string, ts string, is_unsafe boolean").withColumn("h", F.lit("10"))
    return {r["row_id"]: r for r in dedup.near_duplicates(df, **how).collect()}


def test_near_duplicates(spark):
    chain = near(spark, [("aaaa000000000000", "9", "5", "t1"), ("aaaa000000000007", "1", "5", "t1"), ("aaaa00000000003f", "2", "5", "t1"), ("bbbb000000000000", "2", "5", "t1")])
    assert len(chain) == 3 and chain[0]["kept"] and (chain[2]["ham_to_rep"], chain[2]["dupe_flag"]) == (6, "near") and chain[0]["keep_reason"] == "highest_aesthetic"
    first_digit = [("0aaa000000000000", "1", "5", ""), ("1aaa000000000000", "1", "6", "")]
    assert near(spark, first_digit) == {}
    merged = near(spark, first_digit, prefix_hex=0)
    assert merged[1]["kept"] and merged[1]["keep_reason"] == "highest_resolution"
    ties = near(spark, [("ffffffffffffffff", "1", "5", "t2"), ("ffffffffffffffff", "1", "5", "t1"), ("0000000000000000", "1", "5", "t0")])
    assert set(ties) == {0, 1} and ties[1]["kept"] and ties[0]["dupe_flag"] == "identical"
    assert set(near(spark, [("ffff000000000000", "1", "5", ""), ("ffff000000000001", "1", "5", "")], near_thresh=-1)) == set()


def test_close_values_finds_every_pair(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-(2**63), 2**63 - 1, 60)
    values = {int(b) ^ sum(1 << int(i) for i in rng.choice(62, k, replace=False)) for b in base for k in (0, 1, 2, 3, 5)}
    df = spark.createDataFrame([(v,) for v in values], "h long")
    for prefix in (0, 8, 16):
        want = {(a, b) for a in values for b in values if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3 and (prefix == 0 or ((a ^ b) & (1 << 64) - 1) >> (64 - prefix) == 0)}
        got = [(r["a"], r["b"]) for r in dedup.close_values(df, 3, prefix).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_groups(spark):
    rows = [("1", '{"Pokémon": ["Alolan_Raichu", "raichu"]}'), ("2", '{"Pokémon": ["pikachu", "unknown"]}'), ("3", "{}"), ("", '{"Pokémon": ["mew"]}'), ("4", '{"Pokémon": ["Raichu", "Mew"]}')]
    kept, dropped = groups.normalise_tags(spark.createDataFrame(rows, "image_id string, tags string"))
    assert {r["image_id"]: r["species"] for r in kept.collect()} == {"1": "raichu", "3": "", "4": "raichu, mew"}
    assert [r[0] for r in dropped.collect()] == ["2"]
    counted = groups.counts(kept, s.list_of(F.col("species")))
    assert [tuple(r) for r in counted.collect()] == [("raichu", 2), ("mew", 1)]
    assert [r["fraction"] for r in groups.fractions(counted).orderBy("pokemon").collect()] == pytest.approx([1 / 3, 2 / 3])
    many = spark.createDataFrame([(f"n{i:03d}", 1000 - i) for i in range(310)], "pokemon string, count long")
    need = {r["rank"]: r["need"] for r in groups.quotas_by_rank(many).collect()}
    assert (need[100], need[101], need[301], need.get(302)) == (2, 1, 1, None)


def test_quota_split_is_greedy_and_repeatable(spark):
    rng = np.random.default_rng(5)
    rows = [(f"i{i}", ", ".join(sorted({f"s{int(x)}" for x in rng.integers(0, 12, 3)}))) for i in range(80)]
    base = spark.createDataFrame(rows, "image_id string, species string")
    quotas = groups.quotas_by_rank(groups.counts(base, s.list_of(F.col("species"))), 3, 4, 10)
    got = {r["image_id"]: r["split"] for r in groups.quota_split(base, quotas).collect()}
    import hashlib

    taken = set()
    for q in sorted(quotas.collect(), key=lambda r: r["rank"]):
        pool = sorted((hashlib.md5(f"42:{i}".encode()).hexdigest(), i) for i, sp in rows if q["pokemon"] in sp.split(", ") and i not in taken)
        taken |= {i for _, i in pool[: q["need"]]}
    assert {i for i, x in got.items() if x == "val"} == taken and len(got) == 80


def test_positions_and_shards(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("image_id"))
    got = groups.assign_shards(df, 3).collect()
    assert sorted(r["position"] for r in got) == list(range(10))
    assert sorted((r["shard"] for r in got)) == [0] * 4 + [1] * 4 + [2] * 2


def test_attempts_and_quotas(spark):
    rows = spark.createDataFrame([("g", "u", 1), ("g", "u", 2), ("g", "", 3), ("h", "u", 4)], "g string, url string, n int")
    assert sorted(r["n"] for r in ledger.first_seen(rows, "g", "url", "n").collect()) == [1, 4]
    take = ledger.quota_take(spark.createDataFrame([("g", i) for i in range(5)], "g string, n int"), spark.createDataFrame([("g", 3)], "g string, q_r_base int"), "g", "n", spark.createDataFrame([("g",)], "g string"))
    assert sorted(r["n"] for r in take.collect()) == [0, 1]
    status = spark.createDataFrame([(False, None, None, None), (True, False, None, None), (True, True, True, None), (True, True, False, "x"), (True, True, False, "")], "f boolean, v boolean, e boolean, m string")
    assert [r[0] for r in status.select(ledger.attempt_status(*map(F.col, "fvem"))).collect()] == ["http_fail", "invalid_or_corrupt", "duplicate_existing", "io_error", "saved"]


def jpeg(w, h):
    return b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08" + struct.pack(">HH", h, w) + b"\x01\x01\x11\x00"


def test_images(spark):
    px = np.random.default_rng(0).integers(0, 256, (40, 60, 3), dtype=np.uint8)
    png = rasters.encode_png(px)
    assert np.array_equal(rasters.decode_png(png), px) and rasters.probe(png) == ("PNG", 60, 40) and rasters.probe(jpeg(300, 200)) == ("JPEG", 300, 200)
    filtered = bytearray()
    for y in range(3):  # one line of each remaining filter kind, against the definition
        filtered += bytes([y + 2]) + bytes(range(12))
    head = struct.pack(">IIBBBBB", 4, 3, 8, 2, 0, 0, 0)
    raw = b"\x89PNG\r\n\x1a\n" + b"".join(struct.pack(">I", len(b)) + n + b + struct.pack(">I", zlib.crc32(n + b)) for n, b in ((b"IHDR", head), (b"IDAT", zlib.compress(bytes(filtered))), (b"IEND", b"")))
    assert rasters.decode_png(raw)[0].ravel().tolist() == list(range(12))
    df = spark.createDataFrame([(1, rasters.encode_png(np.zeros((200, 150, 3), np.uint8))), (2, png), (3, b"junk"), (4, None), (5, jpeg(300, 200) + b"\xff\xd9"), (6, jpeg(300, 200))], "i int, content binary")
    got = {r["i"]: (r["fmt"], r["w"], r["h"], r["valid"]) for r in media.identified(df).collect()}
    assert got == {1: ("PNG", 150, 200, True), 2: ("PNG", 60, 40, False), 3: (None, None, None, False), 4: (None, None, None, False), 5: ("JPEG", 300, 200, True), 6: (None, None, None, False)}
    hashes = {r["i"]: r["x"] for r in df.select("i", media.perceptual_hash()("content").alias("x")).collect()}
    assert hashes[2] is not None and hashes[3] is None and hashes[4] is None
    noisy = np.clip(px.astype(int) + 2, 0, 255).astype(np.uint8)
    assert ((rasters.perceptual_hash(px) ^ rasters.perceptual_hash(noisy)) & (1 << 64) - 1).bit_count() <= 6
    small = df.where("i = 1").select(media.resized()("content", F.lit(30), F.lit(20), F.lit("AREA"), F.lit(".png")).alias("x")).first()["x"]
    assert rasters.probe(bytes(small)) == ("PNG", 30, 20)


def test_rasters():
    mask = rasters.fill_polygons(20, 20, [np.array([[2, 2], [8, 2], [8, 6], [2, 6]])])
    assert mask[2:7, 2:9].min() == 255 and mask.sum() == 255 * 35
    assert (rasters.dilate(mask, 3) > 0).sum() == 7 * 9
    flat = np.full((1500, 1400, 3), 100, np.uint8)
    painted = rasters.blend_tiles(flat, np.zeros((1500, 1400), np.uint8), lambda p, m: p, above=1000)
    assert np.array_equal(painted, flat)
    assert np.array_equal(rasters.resize(flat[:10, :10], 5, 5, "BICUBIC"), flat[:5, :5])
    assert rasters.convex_hull_area(np.array([[0, 0], [4, 0], [4, 4], [0, 4], [1, 1]])) == 16


def test_polygons(spark):
    square, flat, dart = [[0.0, 0.0], [20.0, 0.0], [20.0, 20.0], [0.0, 20.0]], [[0.0, 0.0], [100.0, 0.0], [100.0, 10.0], [0.0, 10.0]], [[0.0, 0.0], [10.0, 5.0], [0.0, 10.0], [5.0, 5.0]]
    df = spark.createDataFrame([(1, square), (2, flat), (3, dart)], "i int, p array<array<double>>")
    got = {r["i"]: r["s"] for r in df.select("i", polygons.polygon(F.col("p")).alias("s")).collect()}
    assert got[1]["area"] == 400 and got[1]["circularity"] == pytest.approx(np.pi / 4) and got[1]["solidity"] == 1
    assert got[3]["solidity"] == pytest.approx(25 / rasters.convex_hull_area(np.array(dart)))
    boxes = df.groupBy().agg(F.collect_list(F.struct(F.col("p").alias("points"), F.lit(0.9).alias("conf"))).alias("boxes"))
    out = media.text_boxes(boxes).first()
    assert len(out["boxes"]) == 1 and out["has_ocr"] and out["boxes"][0]["area"] == 1000


def test_models_fail_as_rows(spark):
    def build():
        def call(row):
            if row["image_id"] == "bad" or (row["image_id"] == "slow" and row["attempt"] < 3):
                raise RuntimeError
            return {"reply": json.dumps({"r": 50, "a": row["attempt"]})}

        return call

    df = spark.createDataFrame([("ok",), ("slow",), ("bad",)], "image_id string")
    got = {r["image_id"]: (r["status"], r["attempts"], r["reply"]) for r in media.apply_model(df, build, ["image_id"], "reply string", tries=3).collect()}
    assert got["ok"][:2] == ("ok", 1) and got["slow"][:2] == ("ok", 3) and got["bad"] == ("failed", 3, None)
    assert media.temperature(0.9, 9) == 1.0


def test_polygons_of_any_number_of_corners():
    """Against the shoelace formula and the hull of each polygon by itself, with empty and degenerate ones."""
    from siltstone.functions.polygons import measures

    rng = np.random.default_rng(4)
    shapes = [rng.uniform(-50, 50, (n, 2)) for n in (3, 4, 4, 4, 5, 6, 7, 12, 1, 2) for _ in range(5)]
    shapes += [np.zeros((0, 2)), np.array([[0, 0], [4, 0], [4, 4], [0, 4.0]]), np.array([[0, 0], [4, 4], [4, 0], [0, 4.0]])]
    x, y = np.concatenate(shapes).T
    got = measures(x, y, np.array([len(p) for p in shapes])).T
    for p, (area, circularity, aspect, solidity) in zip(shapes, got):
        if not len(p):
            assert (area, circularity, aspect, solidity) == (0, 0, 0, 0)
            continue
        q = np.roll(p, -1, axis=0)
        want = abs(float(np.sum(p[:, 0] * q[:, 1] - q[:, 0] * p[:, 1]))) / 2
        hull = rasters.convex_hull_area(p) if len(p) > 2 else 0.0
        assert area == pytest.approx(want, abs=1e-9) and solidity == pytest.approx(want / hull if hull > 1e-9 else 0.0, abs=1e-6)
        assert aspect > 0 and circularity >= 0
    assert got[-2].tolist() == [16.0, pytest.approx(np.pi / 4), 1.0, 1.0] and got[-1][0] == 0


def test_close_values_with_wide_thresholds(spark):
    """Bands with a radius find every pair, for narrow and wide thresholds, with and without a block."""
    rng = np.random.default_rng(6)
    base = rng.integers(-(2**63), 2**63 - 1, 40, dtype=np.int64)
    values = set(map(int, base))
    for v in map(int, base):
        for flips in (1, 3, 9, 20):
            w = (v & (1 << 64) - 1) ^ sum(1 << int(b) for b in rng.choice(64, flips, replace=False))
            values.add(w - (1 << 64) if w >= 1 << 63 else w)
    df = spark.createDataFrame([(v,) for v in values], "h long")
    ordered = sorted(values)
    for threshold, prefix in ((3, 16), (3, 0), (20, 4), (9, 0), (0, 0)):
        want = {(a, b, d) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if (d := ((a ^ b) & (1 << 64) - 1).bit_count()) <= threshold and (not prefix or (a >> (64 - prefix)) == (b >> (64 - prefix)))}
        got = [tuple(r) for r in dedup.close_values(df, threshold, prefix).collect()]
        assert len(got) == len(set(got)) and set(got) == want, (threshold, prefix)


def test_requests_give_up_what_an_api_refuses():
    from siltstone.operators.ask import messages, send_adapted

    asked = messages("be brief", "score it ", "data:x", (("like this", "data:a", {"r": 1}), ("no picture", None, {})))
    assert [m["role"] for m in asked] == ["system", "user", "assistant", "user"]
    payload = {"model": "m", "temperature": 0.1, "top_p": 1, "response_format": {}, "input": asked}
    seen = []

    def api(**request):
        seen.append(request)
        if "response_format" in request:
            raise TypeError("unexpected keyword")
        if "temperature" in request:
            raise ValueError("'temperature' is not taken")
        return "ok"

    assert send_adapted(api, payload, "JSON only") == ("ok", True)
    assert set(seen[-1]) == {"model", "top_p", "input"} and seen[-1]["input"][1]["content"][0]["text"] == "like this\n\nJSON only"
    assert payload["input"][1]["content"][0]["text"] == "like this" and send_adapted(lambda **r: 7, payload, "") == (7, False)
    with pytest.raises(ValueError, match="overloaded"):
        send_adapted(lambda **r: (_ for _ in ()).throw(ValueError("overloaded")), payload, "")


def test_whole_files_only():
    blob = rasters.encode_png(np.zeros((130, 130, 3), np.uint8))
    assert rasters.intact(blob) and not any(rasters.intact(blob[:n]) for n in range(0, len(blob), 7))
    broken = bytearray(blob)
    broken[60] ^= 1
    assert not rasters.intact(bytes(broken)) and not rasters.intact(None) and rasters.intact(b"\xff\xd8" + b"x" * 20 + b"\xff\xd9")


def test_pictures_are_turned_upright():
    """All eight ways to hold a camera give the same upright picture; other files are left alone."""
    seen = np.arange(6).reshape(2, 3)
    stored = {1: seen, 2: seen[:, ::-1], 3: seen[::-1, ::-1], 4: seen[::-1], 5: seen.T, 6: np.rot90(seen), 7: seen[::-1, ::-1].T, 8: np.rot90(seen, -1)}

    def photo(held, order):
        mark = b"II*\0" if order == "little" else b"MM\0*"
        entry = (0x0112).to_bytes(2, order) + (3).to_bytes(2, order) + (1).to_bytes(4, order) + held.to_bytes(2, order) + b"\0\0"
        body = b"Exif\0\0" + mark + (8).to_bytes(4, order) + (1).to_bytes(2, order) + entry
        return b"\xff\xd8\xff\xe0\x00\x04ab\xff\xe1" + (len(body) + 2).to_bytes(2, "big") + body + b"\xff\xda\x00\x02\xff\xd9"

    for held, pixels in stored.items():
        for order in ("little", "big"):
            assert rasters.orientation(photo(held, order)) == held
            rgb = np.repeat(pixels[:, :, None], 3, axis=2).astype(np.uint8)
            assert np.array_equal(rasters.decode(photo(held, order), lambda b: rgb)[:, :, 0], seen), held
    assert rasters.orientation(jpeg(3, 4)) == 1 and rasters.orientation(b"junk") == 1


def test_data_urls_are_one_line(spark):
    import base64

    contents = [b"", b"x" * 57, b"x" * 58, bytes(range(256)) * 4, None]
    want = [None if c is None else "data:image/png;base64," + base64.b64encode(c).decode() for c in contents]
    assert apply(spark, lambda x: s.data_url(F.lit("a.png"), x), contents, "binary") == want


def test_wide_thresholds_are_compared_by_cells(spark, monkeypatch):
    """All pairs of a block, in as many tasks as its pairs of cells need."""
    monkeypatch.setattr(dedup, "CELL", 32)
    rng = np.random.default_rng(3)
    drawn = [int(v) for v in rng.integers(-(1 << 63), 1 << 63, 1_200)]
    hashes = sorted({*drawn, *[v ^ (1 << i % 63) for i, v in enumerate(drawn[:100])], 0, -1})
    values = spark.createDataFrame([(v,) for v in [*hashes, None]], "h long")
    for threshold, prefix in ((20, 4), (25, 2), (24, 0)):
        found = dedup.close_values(values, threshold, prefix)
        want = set()
        for i, a in enumerate(hashes):
            for b in hashes[i + 1 :]:
                x = (a ^ b) & ((1 << 64) - 1)
                if x.bit_count() <= threshold and (prefix == 0 or x >> (64 - prefix) == 0):
                    want.add((a, b, x.bit_count()))
        got = [tuple(r) for r in found.collect()]
        assert len(got) == len(set(got)) and set(got) == want
        assert found.rdd.getNumPartitions() > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dedup.close_values(values.where("h IS NULL"), 20, 4).count() == 0


def test_hashed_documents_bound_their_batches(spark):
    """The words of a batch are Python objects at once, so rows and bytes of a batch are bounded."""
    from siltstone import queries

    names = {f"spark.sql.execution.arrow.{n}": v for n, v in (("maxRecordsPerBatch", "10000"), ("maxBytesPerBatch", str(1 << 30)))}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        queries.hashed_documents(spark, "/root/testdata/sf0.001")
        rows, size = (int(spark.conf.get(n)) for n in names)
        assert rows <= 1_000 and size <= 4 << 20
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
