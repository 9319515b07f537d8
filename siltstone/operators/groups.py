"""Groups of records by name: aliases, deny-list, counts, quotas, splits and shards."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.documents import name_list, parse
from siltstone.functions.scalars import is_blank, joined, list_of
from siltstone.functions.vocabulary import ALIASES, DENIED


def renamed(names: Column, aliases: dict[str, str] = ALIASES) -> Column:
    """Each name or what it is an alias of."""
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.transform(names, lambda n: F.coalesce(table[n], n))


def denied(names: Column, words: tuple[str, ...] = DENIED) -> Column:
    return F.arrays_overlap(names, F.array(*[F.lit(w) for w in words]))


def normalise(df: DataFrame, names: Column, aliases: dict[str, str] = ALIASES, words: tuple[str, ...] = DENIED) -> tuple[DataFrame, DataFrame]:
    """(kept with ``species``, ids of dropped rows).  Raw names are checked before aliases apply; names whose alias is
    denied go without their row; rows without an id vanish."""
    known = df.where(~is_blank(F.col("image_id"))).withColumn("_names", names)
    bad = F.coalesce(denied(F.col("_names"), words), F.lit(False))
    cleaned = F.filter(renamed(F.col("_names"), aliases), lambda n: ~n.isin(*words))
    return known.where(~bad).withColumn("species", joined(cleaned)).drop("_names"), known.where(bad).select("image_id").distinct()


def normalise_tags(df: DataFrame, tags: str = "tags") -> tuple[DataFrame, DataFrame]:
    return normalise(df, F.coalesce(name_list(parse(F.col(tags))), F.array().cast("array<string>")))


def counts(df: DataFrame, names: Column, least: int = 0) -> DataFrame:
    """(pokemon, count) over rows, each name once a row, in order of count and name."""
    return df.select(F.explode(F.array_distinct(names)).alias("pokemon")).groupBy("pokemon").agg(F.count(F.lit(1)).alias("count")).where(F.col("count") >= least).orderBy(F.col("count").desc(), "pokemon")


def fractions(counted: DataFrame) -> DataFrame:
    """Adds each name's share of all occurrences (not of rows)."""
    total = counted.agg(F.sum("count").alias("_total"))
    return counted.join(F.broadcast(total)).withColumn("fraction", F.when(F.col("_total") > 0, F.col("count") / F.col("_total")).otherwise(0.0)).drop("_total")


def quotas_by_rank(counted: DataFrame, top2: int = 100, one_from: int = 101, one_to: int = 301) -> DataFrame:
    """(pokemon, rank, need): two of the most frequent names, one of the next band.

    Only the first ``max(top2, one_to)`` names can have a quota, so a top-k comes before the rank and the rank's window
    sees that many rows.
    """
    w = Window.orderBy(F.col("count").desc(), "pokemon")
    first = counted.orderBy(F.col("count").desc(), "pokemon").limit(max(top2, one_to))
    need = F.when(F.col("rank") <= top2, 2).when(F.col("rank").between(one_from, one_to), 1)
    return first.withColumn("rank", F.row_number().over(w)).select(F.lower(F.trim("pokemon")).alias("pokemon"), "rank", need.alias("need")).where("need IS NOT NULL")


def quota_split(base: DataFrame, quotas: DataFrame, seed: int = 42, id_col: str = "image_id", species_col: str = "species") -> DataFrame:
    """Adds ``split``: names in rank order each take the rows of smallest seeded hash that no earlier name has taken.

    Earlier names take at most the sum of their needs, so the best ``need + sum of earlier needs`` rows of a name hold
    all it can choose from.  These candidates meet in one group for the greedy walk, which is sequential by its
    definition; their number is set by the quota bands, not by the table, and grows with the square of the sum of needs
    (70,601 ids at most for the default bands).  The table itself is only joined with the outcome.
    """
    ids = base.select(F.col(id_col).alias("_id"), F.explode(F.array_distinct(list_of(F.col(species_col)))).alias("pokemon"))
    earlier = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    bounded = quotas.withColumn("_most", F.col("need") + F.coalesce(F.sum("need").over(earlier), F.lit(0)))
    keyed = ids.distinct().join(bounded, "pokemon").withColumn("_p", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("_id", F.lit("")))))
    placed = keyed.withColumn("_n", F.row_number().over(Window.partitionBy("pokemon").orderBy("_p", "_id"))).where("_n <= _most")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        taken: set[str] = set()
        for _, group in pdf.sort_values(["rank", "_n"]).groupby("rank", sort=True):
            free = [i for i in group["_id"] if i not in taken]
            taken.update(free[: int(group["need"].iloc[0])])
        return pd.DataFrame({"_id": sorted(taken)})

    chosen = placed.select("_id", "rank", "need", "_n", F.lit(1).alias("_all")).groupBy("_all").applyInPandas(walk, "_id string")
    marked = base.join(chosen.withColumn("_val", F.lit(True)), F.col(id_col) == F.col("_id"), "left")
    return marked.withColumn("split", F.when(F.col("_val"), "val").otherwise("train")).drop("_id", "_val")


def split_counts(df: DataFrame, species_col: str = "species") -> DataFrame:
    """(split, pokemon, count, fraction) with fractions inside each split."""
    per = df.select("split", F.explode(F.array_distinct(list_of(F.col(species_col)))).alias("pokemon")).groupBy("split", "pokemon").agg(F.count(F.lit(1)).alias("count"))
    return per.withColumn("fraction", F.col("count") / F.sum("count").over(Window.partitionBy("split")))


def split_totals(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "val").alias("val"))


def unique_by_id(df: DataFrame, id_col: str = "image_id", seed: int = 42) -> DataFrame:
    """One row per id: train before val, then by seeded hash."""
    rank = F.struct((F.col("split") != "train").alias("v"), shuffle_key(F.col("path"), seed).alias("k"))
    w = Window.partitionBy(id_col).orderBy(rank)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def shuffle_key(id_col: Column, seed: int = 42) -> Column:
    """Seeded order that reruns repeat."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))))


def seeded_limit(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    return df.orderBy(shuffle_key(F.col(id_col), seed), id_col).limit(n)


def with_position(df: DataFrame, *order: Column, out: str = "position", parts: int | None = None) -> DataFrame:
    """Adds the row's place (from 0) in a global order without pulling all rows into one task.

    Rows are range-partitioned and sorted; each partition counts its rows, running sums over these counts (one row per
    partition) give its start, and rows are numbered inside their partition.
    """
    from siltstone.storage import materialize

    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_key", F.struct(*order))
    dealt = materialize(keyed.repartitionByRange(n, "_key").withColumn("_part", F.spark_partition_id()), "positions")
    counted = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_c"))
    starts = counted.withColumn("_start", F.coalesce(F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_start")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy("_key"))
    return dealt.join(starts, "_part").withColumn(out, (F.col("_start") + inside - 1).cast("long")).drop("_key", "_part", "_start")


def assign_shards(df: DataFrame, shards: int, id_col: str = "image_id", seed: int = 42) -> DataFrame:
    """Adds ``shard`` and ``position``: ``ceil(n / shards)`` rows to a shard in seeded order, so fewer shards may fill."""
    n = df.count()
    per = max(1, -(-n // shards))
    return with_position(df, shuffle_key(F.col(id_col), seed), F.col(id_col)).withColumn("shard", F.floor(F.col("position") / per).cast("int"))


def manifest(df: DataFrame, id_col: str = "image_id") -> DataFrame:
    """(split, count, sha256) of each split's sorted id list, one id a line.

    The digest is that of the manifest file, which is one sequence of bytes: sorted partitions stream through the
    driver one after the other, so memory does not grow with the list.
    """
    spark = df.sparkSession
    out = []
    for split in ("train", "val"):
        digest, n = hashlib.sha256(), 0
        for row in id_list(df, split, id_col).orderBy(id_col).toLocalIterator():
            digest.update((b"\n" if n else b"") + (row[0] or "").encode())
            n += 1
        digest.update(b"\n")
        out.append((split, n, digest.hexdigest()))
    return spark.createDataFrame(out, "split string, count long, sha256 string")


def id_list(df: DataFrame, split: str, id_col: str = "image_id") -> DataFrame:
    return df.where(F.col("split") == split).select(id_col)


