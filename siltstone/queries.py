"""The operators of the library as queries over the test tables.

Documents with their labels stand in for the ledger: ids and scores come from hashes of the text, unsafe means toxic.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import documents as d
from siltstone.functions import scalars as s
from siltstone.operators import captions, dedup, groups, ledger, rank
from siltstone.operators.media import text_boxes
from siltstone.storage import bounded_batches, materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _byte(h: Column, i: int) -> Column:
    return F.conv(F.substring(h, 2 * i + 1, 2), 16, 10).cast("int")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger row per document; unlabelled ones are not flagged."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", F.md5("text").alias("image_id"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    h = F.col("image_id")
    joined = docs.join(labels, "doc_id", "left")
    return joined.select(
        "doc_id", F.col("doc_id").alias("row_id"), "image_id", "source", "n_chars", F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("is_unsafe"), F.lit(None).cast("string").alias("dupe_removed"),
        (_byte(h, 0) % 101).alias("ae_relevance"), (_byte(h, 1) % 101).alias("ae_aesthetic"), (_byte(h, 2) * 8 + 100).alias("w"), (_byte(h, 3) * 8 + 100).alias("h"),
    )


def gate_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = rank.gate(ledger.anti_filter(images(spark, sf_dir), "is_unsafe", "dupe_removed"))
    best = rank.top_n(passed, 100, s.effective_score(F.col("ae_relevance").cast("double"), F.col("ae_aesthetic").cast("double")), "doc_id")
    return best.select("doc_id", "image_id", "ae_relevance", "ae_aesthetic", F.round("effective", 6).alias("effective"), s.size_text(F.col("w"), F.col("h")).alias("image_size"))


def flag_antifilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.anti_filter(images(spark, sf_dir), "is_unsafe").select("doc_id", "image_id")


def truthy_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.array(*map(F.lit, (" TRUE ", "1", "t", "1.0", "false", "", "no", "Y")))
    said = F.element_at(words, (F.col("doc_id") % 8 + 1).cast("int"))
    return table(spark, sf_dir, "labels").select("doc_id", said.alias("said")).select("doc_id", "said", s.truthy(F.col("said")).alias("flag"))


def exact_content_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of groups of equal content, by representative (smallest id); found by an aggregate on the hash."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("image_id"))
    firsts = rows.groupBy("image_id").agg(F.count(F.lit(1)).alias("members"), F.min("doc_id").alias("first_id")).where("members > 1")
    return rows.join(firsts, "image_id").select("doc_id", "image_id", "members", "first_id")


def hashed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, h): the leading 60 bits of a 64-bit hash from word votes, counted inside the row; texts without words have none."""
    bounded_batches(spark, rows=1_000, megabytes=4)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = F.array_distinct(F.filter(F.split(F.lower("text"), "[^a-z0-9]+"), lambda w: w != ""))
    return docs.select("doc_id", words.alias("w")).where(F.size("w") > 0).select("doc_id", _majority("w").alias("h"))


class _WordBits(dict):
    """The leading 60 bits of a word's MD5, remembered up to a bound: frequent words are hashed once a worker."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 100_000:
            self.clear()
        value = self[word] = int(hashlib.md5(word.encode()).hexdigest()[:15], 16)
        return value


_word_bits = _WordBits()


@F.arrow_udf(T.LongType())
def _majority(listed: pa.Array) -> pa.Array:
    """The 60 bits that more than half of the words of a list have in their hashes, above four zeros."""
    counts = np.asarray(listed.value_lengths())
    ends = np.cumsum(counts)
    words = listed.flatten().to_pylist()
    flat = np.fromiter(map(_word_bits.__getitem__, words), np.uint64, len(words)).astype(">u8")
    out = np.zeros(len(counts), np.int64)
    begin = 0
    while begin < len(counts):  # slices of about 25,000 numbers, as each takes 540 bytes when its bits are summed
        base = ends[begin] - counts[begin]
        end = max(begin + 1, int(np.searchsorted(ends, base + 25_000, "right")))
        bits = np.unpackbits(flat[base : ends[end - 1]].view(np.uint8).reshape(-1, 8), axis=1)[:, 4:]
        votes = np.add.reduceat(bits, ends[begin:end] - counts[begin:end] - base, axis=0, dtype=np.int64)
        most = np.zeros((end - begin, 64), np.uint8)
        most[:, :60] = 2 * votes > counts[begin:end, None]
        out[begin:end] = np.packbits(most, axis=1).view(">i8").ravel()
        begin = end
    return pa.array(out)


def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of distinct hash values within 3 bits, 16 leading bits equal."""
    values = materialize(hashed_documents(spark, sf_dir), "hashes").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    return dedup.close_values(values, 3, 16)


def near_dup_pairs_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = materialize(hashed_documents(spark, sf_dir), "hashes").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    return dedup.close_values(values, 3, 0)


def near_dup_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(hashed_documents(spark, sf_dir), "hashes").withColumnRenamed("h", "hash")
    return dedup.clusters(rows, "hash", 3, 16).select("doc_id", F.col("h").alias("hash"), "cluster")


def near_dup_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashes = materialize(hashed_documents(spark, sf_dir), "hashes")
    hexes = hashes.select("doc_id", F.lpad(F.lower(F.hex("h")), 16, "0").alias("phash64"))
    rows = images(spark, sf_dir).join(hexes, "doc_id")
    audit = dedup.near_duplicates(rows)
    return audit.select(F.col("row_id").alias("doc_id"), "rep_image_id", "dupe_flag", "ham_to_rep", "kept", "keep_reason")


def embedding_bit_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors whose sign bits differ in 1 to 20 places, 4 leading bits equal; those with the same bits are no pair."""
    bits = F.aggregate("embedding", F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, 1).bitwiseOR(F.when(x > 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))))
    rows = materialize(table(spark, sf_dir, "embeddings").select("vec_id", bits.alias("h")), "bits")
    pairs = dedup.close_values(rows.select("h").distinct(), 20, 4)
    a, b = (rows.select(F.col("vec_id").alias(i), F.col("h").alias(h)) for i, h in (("x", "a"), ("y", "b")))
    return pairs.join(a, "a").join(b, "b").select(F.least("x", "y").alias("vec_a"), F.greatest("x", "y").alias("vec_b"), F.col("distance").cast("int").alias("distance"))


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", s.domain(url).alias("domain"), s.extension(url).alias("ext"))


def url_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", s.domain(F.col("url")).alias("domain"), F.split_part("url", F.lit("?"), F.lit(1)).alias("url"))
    return ledger.first_seen(rows, "domain", "url", "page_id").select("page_id", "domain")


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", (F.col("l_quantity").cast("int") * 113 + 100).alias("w"), (F.col("l_linenumber") * 811 + F.col("l_quantity").cast("int") * 7).alias("h"))


def resize_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.col("w"), F.col("h")
    t = F.col("t")
    planned = _sizes(spark, sf_dir).withColumn("t", s.target_size(w, h))
    return planned.select("l_orderkey", "l_linenumber", t["new_w"].alias("new_w"), t["new_h"].alias("new_h"), F.round(t["scale"], 6).alias("scale"), t["kernel"].alias("kernel"), t["action"].alias("action"), F.round(F.greatest(w, h) / F.least(w, h), 4).alias("ar"))


def resize_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = _sizes(spark, sf_dir).withColumn("t", s.target_size(F.col("w"), F.col("h"), strict=True))
    return ledger.status_counts(planned.select(F.col("t.action").alias("action"), F.col("t.kernel").alias("kernel")), "action", "kernel")


def band_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as quota rows: band by size, rank by price."""
    fields = F.element_at(F.array(*map(F.lit, ("1-150 (a)", "151-500", "band3", " 801-1025 x"))), (F.col("p_size") % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", s.band_of(fields).alias("band"), F.least(F.col("p_size"), F.lit(20)).alias("quota"))
    return rows.select("p_partkey", "band", "quota", s.folder_name(F.col("p_partkey"), F.col("p_name")).alias("folder"))


def quota_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines of each part in order of arrival, up to the part's quota less what two statuses already hold."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"))
    quotas = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") % 5 + 2).alias("q_r_base"))
    present, fresh = ledger.split_by(li, F.col("l_returnflag") == "A")
    return ledger.quota_take(fresh, quotas, "l_partkey", "line", present).select("l_partkey", "line")


def caption_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir)


def upsert_only_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, only_missing=True)


def upsert_require_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert(spark, sf_dir, require_all=True)


def _upsert(spark: SparkSession, sf_dir: str, **how: bool) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("image_id"), F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("old "), "source")).otherwise("").alias("caption"), "lang")
    base = docs.withColumn("tags", F.when(F.col("image_id") % 3 != 0, F.col("lang"))).drop("lang")
    fresh = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("image_id"), F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("new "), F.col("quality").cast("string"))).otherwise(" ").alias("caption"), F.when(F.col("doc_id") % 7 != 0, F.lit("fresh")).alias("tags"))
    return captions.upsert(base, fresh, **how).select("image_id", "caption", "tags")


def semi_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return ledger.mark_by_keys(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), buyers, "c_custkey", "urgent").select("c_custkey", "urgent")


def anti_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without urgent orders."""
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return ledger.not_done(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), urgent, "c_custkey")


def contains_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows that withdrawal of some hashes leaves: by id or by the hash within the path, of one stage only."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"), "source")
    drops = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("h")).otherwise("").alias("image_id"), F.concat(F.lit("/raw/x_"), F.col("h"), F.lit(".png")).alias("path_raw"), F.when(F.col("doc_id") % 5 == 0, "ocr").otherwise("nsfw").alias("stage"))
    hashes = ledger.hashes_in(docs.where("doc_id % 3 = 0").select(F.concat(F.lit("see "), F.upper("h")).alias("t")))
    return ledger.withdraw_drops(drops, hashes, "nsfw")[0].select("doc_id", "stage")


def md5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.hashes_in(table(spark, sf_dir, "documents").select("text"))


def alias_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as lists of names, with aliases and a deny-list that fit them."""
    return _species(spark, sf_dir)[0].select("image_id", "species")


def deny_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _species(spark, sf_dir)[1]


def _species(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("image_id"), "p_name", "p_brand")
    names = F.concat(F.split(F.lower("p_name"), " "), F.array(F.lower("p_brand")))
    return groups.normalise(parts, names, {"brand#1": "brand one", "brand#2": "brand two", "brand#11": "brand eleven"}, ("brand#3", "brand#33"))


def species_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.counts(_species(spark, sf_dir)[0], F.split("species", ", "), 2)


def rank_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = groups.counts(_species(spark, sf_dir)[0], F.split("species", ", "))
    return groups.quotas_by_rank(counted, 5, 6, 20)


def quota_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _species(spark, sf_dir)[0]
    quotas = groups.quotas_by_rank(groups.counts(kept, F.split("species", ", ")), 5, 6, 20)
    return groups.quota_split(kept, quotas).select("image_id", "split")


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _species(spark, sf_dir)[0].withColumn("split", F.when(F.col("image_id").cast("long") % 10 == 0, "val").otherwise("train"))


def split_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.split_counts(_split(spark, sf_dir)).withColumn("fraction", F.round("fraction", 9))


def split_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.split_totals(_split(spark, sf_dir))


def manifest_sha(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.manifest(_split(spark, sf_dir).select("image_id", "split"))


def tags_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other document is damaged the way that the repair mends."""
    raw = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.concat(F.replace("props", F.lit('"'), F.lit('""')), F.lit(",")))
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(d.parse(raw), "$.k", "long").alias("k"))


def score_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of a scorer: whole numbers, text, null beside a short form, and no JSON at all."""
    i = F.col("event_id")
    v = F.round(F.col("value"), 2).cast("decimal(12,2)").cast("string")
    reply = (
        F.when(i % 5 == 0, F.concat(F.lit('```json {"r": '), v, F.lit(', "a": "'), v, F.lit('"} ```')))
        .when(i % 5 == 1, F.concat(F.lit('{"relevance": 90, "r": 10, "a": '), v, F.lit("}")))
        .when(i % 5 == 2, F.lit('{"relevance": null, "r": 10, "a": 5}'))
        .when(i % 5 == 3, F.lit("no scores"))
        .otherwise(F.lit('{"r": true, "a": -3}'))
    )
    scored = table(spark, sf_dir, "events").select("event_id", d.parse_scores(reply).alias("x"))
    return scored.select("event_id", F.col("x.relevance").alias("relevance"), F.col("x.aesthetic").alias("aesthetic"))


def sentence_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", s.sentence(F.col("text")).alias("sentence"))


def snake_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", s.snake(F.concat_ws("--", "p_type", "p_brand")).alias("token"))


def hybrid_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions of parts: the name as facets and the brand as a name with a form."""
    form = F.element_at(F.array(F.lit("mega_x"), F.lit("hisuian"), F.lit("odd form"), F.lit(None).cast("string")), (F.col("p_partkey") % 4 + 1).cast("int"))
    doc = F.to_json(F.struct(F.array("p_brand").alias("Pokémon"), F.array(form).alias("form"), (F.col("p_size") % 2 == 0).alias("shiny_presence"), F.split("p_name", " ").alias("actions"), F.col("p_type").alias("pose"), F.lit("multiple").alias("subject_count"), (F.col("p_size") > 25).alias("multi_panel")), {"ignoreNullFields": "false"})
    raw = F.when(F.col("p_partkey") % 9 == 0, F.lit("not json")).otherwise(doc)
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("A "), "p_name", F.lit(".")).alias("caption"), raw.alias("tags"))
    return captions.hybrid_captions(rows).select("p_partkey", "hybrid_caption")


def screen_nameless(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("p_partkey")
    raw = F.when(i % 6 == 0, None).when(i % 6 == 1, "{bad").when(i % 6 == 2, '{"Pokémon": []}').when(i % 6 == 3, '{"Pokémon": [" "]}').when(i % 6 == 4, '{"Pokémon": "Mew"}').otherwise(F.to_json(F.struct(F.array("p_name").alias("Pokémon"))))
    return captions.screen(table(spark, sf_dir, "part").select("p_partkey", raw.alias("tags")))[1].select("p_partkey")


def max_tag_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first elements of the vectors as tag scores."""
    tags = tuple(f"t{i}" for i in range(8))
    scores = F.create_map(*[x for i, t in enumerate(tags) for x in (F.lit(t), F.col("embedding")[i].cast("double"))])
    rows = table(spark, sf_dir, "embeddings").select("vec_id", scores.alias("scores"))
    out = ledger.flag_by_score(rows, "scores", 0.2, tags)
    return out.select("vec_id", F.round("is_unsafe_score", 6).alias("score"), "is_unsafe", F.split_part(F.split_part("is_unsafe_tags", F.lit(";"), F.lit(1)), F.lit(":"), F.lit(1)).alias("best_tag"))


def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.seeded_limit(table(spark, sf_dir, "documents").select("doc_id", "source"), 50, "doc_id")


def shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.assign_shards(table(spark, sf_dir, "documents").select("doc_id"), 16, "doc_id").select("doc_id", "position", "shard")


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    status = ledger.attempt_status(i % 7 != 0, i % 5 != 0, i % 11 == 0, F.when(i % 13 == 0, "disk full"))
    return ledger.status_counts(table(spark, sf_dir, "pages").select(status.alias("status")), "status")


def polygon_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes from line items: rectangles sheared by the discount."""
    w, h, k = F.col("l_quantity"), F.col("l_linenumber") * 5.0, F.col("l_tax") * 100
    corners = F.array(F.array(F.lit(0.0), F.lit(0.0)), F.array(w, F.lit(0.0)), F.array(w + k, h), F.array(k, h))
    boxes = F.array(F.struct(corners.alias("points"), F.col("l_discount").alias("conf")))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", boxes.alias("boxes"))
    kept = text_boxes(rows, least_conf=0.035).select("l_orderkey", "l_linenumber", F.explode("boxes").alias("b"))
    return kept.select("l_orderkey", "l_linenumber", F.round("b.area", 4).alias("area"), F.col("b.conf").alias("conf"))


def size_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("p_partkey")
    raw = F.when(i % 4 == 0, F.concat_ws("x", "p_size", i.cast("string"))).when(i % 4 == 1, "0x5").when(i % 4 == 2, "ax5").otherwise("")
    return table(spark, sf_dir, "part").select("p_partkey", s.parse_size(raw).alias("z")).select("p_partkey", "z.w", "z.h")


def keyed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model results by id, or by path where the row has no id."""
    base = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey").cast("string")).otherwise("").alias("id"), F.col("c_name").alias("path"), "c_custkey")
    results = base.where("c_custkey % 3 = 0").select("id", "path", (F.col("c_custkey") * 2).alias("result"))
    return ledger.keyed_update(base, results, "id", "path", ["result"]).select("c_custkey", "result")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries of the library by name."""
    helpers = {"table", "images", "hashed_documents", "materialize", "queries"}
    return {n: f for n, f in globals().items() if callable(f) and getattr(f, "__module__", "") == __name__ and not n.startswith("_") and n not in helpers}
