"""Near-duplicate detection with circulant MinHash, banding and exact Jaccard verification.

A document's set holds its distinct shingles of k words.  Circulant MinHash needs two permutations only: sigma breaks
the structure of the shingle universe once, and pi, shifted circularly by 1, 2, 3, ..., yields every coordinate:
h_k(x) = pi(sigma(x) + k mod 2**32).  Both are bijections of 32-bit numbers, so they are applied as arithmetic.

Signatures are cut into ``BANDS`` bands of ``ROWS`` coordinates.  At a similarity of 0.8 a pair shares no band with
probability (1 - 0.8**5)**32 = 3e-6; every link is confirmed on the full sets.

Scale and skew:
- documents with equal sets form a class first and are represented by the smallest id, so thousands of exact copies
  cost one signature from then on;
- texts stay where they are until candidates are known; only ids, sizes and band hashes are shuffled;
- inside a bucket no all pairs are emitted: members are compared with one leader (a star).  Where a bucket still holds
  several components, its hub - the member with the best share of links so far - is the next leader, for a few rounds;
- what is left unsettled is searched by an exact prefix filter on the shingles of those texts alone, so no link between
  different texts of a bucket is lost and texts that only share a passage never meet;
- components come from label propagation with pointer jumping over edge tables, never on the driver; every round is
  written to the shared folder, which cuts the lineage and survives lost executors.

Defined results: null and empty texts have an empty set, are linked with nothing and are their own component; a text
of fewer than k words has its whole sequence as its one shingle; rows that repeat an id are one document whose texts
are all its own (each row is returned, and links of any of them hold for the id); a null id is never linked;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.operators.components import components, merge_labels
from siltstone.storage import bounded_batches, materialize

BANDS, ROWS = 32, 5
#: Rounds of comparing buckets with a better leader before the exact search for what is left.
HUB_ROUNDS = 3


class _WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, seed=11) >> 1
        return value


_hashes = _WordHashes()


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    words = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    width = min(k, len(ids))
    n = len(ids) - width + 1
    h = np.full(n, np.uint64(width))
    for j in range(width):
        h = _mix64(h * np.uint64(0x100000001B3) + ids[j : j + n])
    return np.unique(h)


def sigma(x: np.ndarray) -> np.ndarray:
    """First permutation of the universe of 32-bit numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def pi(x: np.ndarray) -> np.ndarray:
    """Second permutation; changes ``x``."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x21F0AAAD)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x735A2D97)
    x ^= x >> np.uint32(15)
    return x


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of minima per (non-empty) set; sets are laid end to end and read in blocks that stay in cache."""
    out = np.empty((len(sets), coordinates), np.uint32)
    begin = 0
    while begin < len(sets):
        end, total = begin, 0
        while end < len(sets) and (end == begin or total + len(sets[end]) <= 32_768):
            total += len(sets[end])
            end += 1
        flat = sigma(np.concatenate(sets[begin:end]).astype(np.uint32))
        starts = np.cumsum([0, *[len(s) for s in sets[begin : end - 1]]])
        scratch = np.empty_like(flat)
        for k in range(coordinates):
            np.add(flat, np.uint32(k), out=scratch)
            out[begin:end, k] = np.minimum.reduceat(pi(scratch), starts)
        begin = end
    return out


def _sign(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            sets = [shingles(t, k) for t in texts]
            full = [i for i, s in enumerate(sets) if len(s)]
            sizes = np.array([len(s) for s in sets], np.int64)
            marks: list[bytes | None] = [xxhash.xxh3_128_digest(s) if len(s) else None for s in sets]
            keys = np.zeros((len(sets), bands), np.int64)
            if full:
                coordinates = signatures([sets[i] for i in full], bands * rows).astype(np.uint64).reshape(len(full), bands, rows)
                h = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(full), bands)).copy()
                for r in range(rows):
                    h = _mix64(h * np.uint64(0x100000001B3) + coordinates[:, :, r])
                keys[full] = h.view(np.int64)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(sets) + 1) * bands, bands, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(sizes), pa.array(marks, pa.binary()), listed], names=["_id", "n_shingles", "mark", "bands"])

    return run


def _confirm(k: int, percent: int):
    """(a, b, texts) -> pairs whose full sets are similar; sets of recent texts are remembered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[str, np.ndarray] = {}

        def of(text: str) -> np.ndarray:
            if text not in recent:
                if len(recent) >= 64:
                    recent.clear()
                recent[text] = shingles(text, k)
            return recent[text]

        for batch in batches:
            linked = []
            for ta, tb in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist()):
                a, b = of(ta), of(tb)
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int, label: str) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, and those that are not, with ``linked``."""
    ta, tb = texts.select(F.col("id").alias("a"), F.col("_text").alias("ta")), texts.select(F.col("id").alias("b"), F.col("_text").alias("tb"))
    joined = pairs.join(tb, "b").join(ta, "a").select("a", "b", "ta", "tb")  # a leader's text last: it is not shuffled
    return materialize(joined.mapInArrow(_confirm(k, percent), "a long, b long, linked boolean"), label)


def _possible(x: Column, y: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar at all."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (band, id, n, c) of buckets that still hold several components ``c``."""
    told = members.join(labels, "id", "left").select("band", "id", "n", F.coalesce("component", "id").alias("c"))
    mixed = told.groupBy("band").agg(F.min("c").alias("least"), F.max("c").alias("most")).where("least <> most").select("band")
    return told.join(materialize(mixed, "mixed"), "band")  # written first, so that its size is known and members are not dealt by band for it


def _hub_pairs(left: DataFrame, compared: DataFrame, percent: int) -> DataFrame:
    """Pairs of each bucket's hub with its members of other components.

    The hub is the member with the largest share of links among its comparisons so far: the text that others are
    copies of is similar to nearly all that it met, while two copies of it are often just too different.
    """
    ends = compared.select(F.col("a").alias("id"), "linked").union(compared.select(F.col("b").alias("id"), "linked"))
    share = ends.groupBy("id").agg((F.count_if("linked") / (F.count(F.lit(1)) + 2)).alias("share"))
    rated = left.join(share, "id", "left").select("band", "id", "n", "c", F.coalesce("share", F.lit(0.0)).alias("share"))
    hubs = rated.groupBy("band").agg(F.max(F.struct("share", (-F.col("id")).alias("i"), "id", "n", "c")).alias("hub")).select("band", "hub")
    met = rated.join(hubs, "band").where((F.col("c") != F.col("hub.c")) & _possible(F.col("n"), F.col("hub.n"), percent))
    pairs = met.select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct()
    known = compared.select("a", "b").union(compared.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.join(known, ["a", "b"], "left_anti")


def _prefix_pairs(left: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """All pairs a < b of different components that can be similar, by exact prefix filtering.

    Sets of at least ``percent`` similarity share one of the rarest n - ceil(n * percent / 100) + 1 shingles of each.
    Shingles that only one text has come first in that order and need no row, so texts that merely share a frequent
    passage have nothing left to meet by.  Where two texts first meet, what is left of each (``rest``) bounds what they
    share, and pairs that it leaves too little are not made: copies that all differ by more than a ninth never meet.
    """
    held = texts.join(left.select("id").distinct(), "id", "left_semi").mapInArrow(_sets(k), "id long, x long")
    held = materialize(held, "shingles")
    shared = held.groupBy("x").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    common = held.join(shared, "x").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("f", "x"))).alias("common"))
    alone = F.col("n") - F.size("common")
    room = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - alone
    first = F.slice("common", F.lit(1), F.greatest(F.lit(0), room).cast("int"))
    prefixes = left.join(common, "id").select("id", "n", "c", alone.alias("alone"), F.posexplode(first).alias("p", "s"))
    prefixes = materialize(prefixes.select("id", "n", "c", (F.col("n") - F.col("alone") - F.col("p")).alias("rest"), F.col("s.x").alias("x")), "prefixes")
    u, v = prefixes.alias("u"), prefixes.alias("v")
    enough = F.least("u.rest", "v.rest") * (100 + percent) >= (F.col("u.n") + F.col("v.n")) * percent
    met = u.join(v, (F.col("u.x") == F.col("v.x")) & (F.col("u.c") < F.col("v.c")) & _possible(F.col("u.n"), F.col("v.n"), percent) & enough)
    return met.select(F.least("u.id", "v.id").alias("a"), F.greatest("u.id", "v.id").alias("b")).distinct()


def _sets(k: int):
    """(id, shingle hash) rows of texts, in batches of about 100,000 rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(ids: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(ids, np.int64), [len(x) for x in sets])), pa.array(np.concatenate(sets))], names=["id", "x"])

        for batch in batches:
            ids, sets, held = [], [], 0
            for i, text in zip(batch.column("id").to_pylist(), batch.column("_text").to_pylist()):
                ids.append(i)
                sets.append(shingles(text, k).view(np.int64))
                held += len(sets[-1])
                if held >= 100_000:
                    yield made(ids, sets)
                    ids, sets, held = [], [], 0
            if ids:
                yield made(ids, sets)

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: the id, ``n_shingles``, ``component_id`` and ``kept`` (id = component_id)."""
    bounded_batches(docs.sparkSession)
    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    signed = materialize(picked.mapInArrow(_sign(k, bands, rows), "_id long, n_shingles long, mark binary, bands array<long>"), "signatures")

    linkable = signed.where("mark IS NOT NULL AND _id IS NOT NULL")
    classes = linkable.groupBy("mark").agg(F.min("_id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = materialize(classes, "classes")
    buckets = classes.select("id", "n", F.explode("bands").alias("band"))
    leaders = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("id", "n")).alias("leader")).where("members > 1")
    members = materialize(buckets.join(leaders, "band").select("band", "id", "n", F.col("leader.id").alias("leader"), F.col("leader.n").alias("leader_n"), "members"), "members")

    wanted = members.select(F.col("id").alias("_id")).distinct()
    texts = materialize(picked.where("_text IS NOT NULL").join(wanted, "_id").select(F.col("_id").alias("id"), "_text"), "texts")
    star = members.where("id <> leader").where(_possible(F.col("n"), F.col("leader_n"), percent)).select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    compared = _verified(star, texts, k, percent, "star")
    members = members.where("members > 2").select("band", "id", "n")  # with the leader a bucket of two has met all of its pairs
    # One round of labels is enough to see which buckets are settled; whole components come before the exact search.
    labels = components(compared.where("linked"), rounds=1)
    left = materialize(_unsettled(members, labels), "unsettled")
    for _ in range(HUB_ROUNDS):
        if left.isEmpty():
            break
        fresh = _verified(_hub_pairs(left, compared, percent), texts, k, percent, "hubs")
        compared = materialize(compared.union(fresh), "compared")
        if fresh.where("linked").isEmpty():
            break
        labels = merge_labels(labels, fresh.where("linked"))
        left = materialize(_unsettled(left.select("band", "id", "n"), labels), "unsettled")
    # An id that comes with several texts ties the classes of these texts together.
    in_class = linkable.join(classes.select("mark", "id"), "mark").select("_id", "id")
    several = in_class.groupBy("_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z").select("_id", "a")
    same = materialize(in_class.join(several, "_id").where("a <> id").select("a", F.col("id").alias("b")), "same")
    final = components(compared.where("linked").select("a", "b").union(same))
    left = materialize(_unsettled(left.select("band", "id", "n"), final).select("id", "n", "c").distinct(), "unsettled")
    if not left.isEmpty():
        rest = _prefix_pairs(left, texts, k, percent).join(compared.select("a", "b"), ["a", "b"], "left_anti")
        more = _verified(rest, texts, k, percent, "rest").where("linked")
        if not more.isEmpty():
            final = merge_labels(final, more)
    of_class = classes.join(final, "id", "left").select("mark", F.coalesce("component", "id").alias("component_id"))
    done = signed.select(F.col("_id").alias(id_col), "n_shingles", F.when(F.col("_id").isNotNull(), F.col("mark")).alias("mark")).join(of_class, "mark", "left")
    component = F.coalesce("component_id", F.col(id_col))
    return done.select(id_col, "n_shingles", component.alias("component_id"), F.coalesce(component == F.col(id_col), F.lit(True)).alias("kept"))
