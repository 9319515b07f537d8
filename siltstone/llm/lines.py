"""Line dedup by overlapping windows of three lines.

Every three consecutive lines of a document are hashed.  A window that the corpus holds more than once is repeated;
its first occurrence stays and the lines of all later ones go.  Windows overlap, so a passage of n lines is covered by
n - 2 windows, and the removed lines are the union of the covered places.

Only hashes, ids and places are shuffled to find repeats.  First occurrences come from a minimum, which is combined
before the shuffle, so a window that a third of all documents hold costs each task one row.  The join that marks later
occurrences has one row per window on one side; Spark splits the other side where a window is very frequent.

A document is its id together with its text.  Defined results: lines without a word neither form windows nor go, but
when all other lines of the text went; documents of fewer than three such lines are never changed; null and empty
texts stay as they are; rows with the same id and text are one document and get the same result; among documents the
smaller id is the earlier (null ids last), then the smaller text hash; an empty table gives an empty result; other
input columns are carried, those named like an added column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3
ADDED = ("n_lines", "n_removed", "removed")


def _key(id_col: str, text_col: str) -> list[Column]:
    return [F.col(f"`{id_col}`").alias("_id"), F.xxhash64(F.col(f"`{text_col}`"), F.lit(3)).alias("_t")]


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(_id, _t, covered): for each document with later occurrences, the sorted places of their lines."""
    lines = F.filter(F.transform(F.split(F.col(f"`{text_col}`"), "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].rlike(r"[^\x20\x09-\x0D]"))
    held = docs.where(F.col(f"`{text_col}`").isNotNull()).select(*_key(id_col, text_col), lines.alias("_lines")).where(F.size("_lines") >= window)

    def line(i: Column, k: int) -> Column:
        return F.get("_lines", i + k)["x"]

    # Two hashes with different seeds stand for the lines of a window: 128 bits.
    windows = F.transform(F.sequence(F.lit(0), F.size("_lines") - window), lambda i: F.struct(
        F.xxhash64(F.lit(1), *[line(i, k) for k in range(window)]).alias("a"),
        F.xxhash64(F.lit(2), *[line(i, k) for k in reversed(range(window))]).alias("b"),
        *[F.get("_lines", i + k)["i"].alias(f"p{k}") for k in range(window)],
    ))
    places = held.select("_id", "_t", F.explode(windows).alias("_w")).select("_id", "_t", "_w.*")
    # Nulls sort first in a minimum of structs; the flag puts null ids last.
    first = places.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(F.col("_id").isNull().alias("u"), F.col("_id").alias("v"), F.col("_t").alias("t"), F.col("p0").alias("p"))).alias("_first")).where("_n > 1")
    later = places.join(first.select("a", "b", "_first"), ["a", "b"]).where(~(F.col("_id").eqNullSafe(F.col("_first.v")) & (F.col("_t") == F.col("_first.t")) & (F.col("p0") == F.col("_first.p"))))
    return later.groupBy("_id", "_t").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array(*[f"p{k}" for k in range(window)]))))).alias("_covered"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The input rows with the later occurrences cut out of the text, ``n_lines``, ``n_removed`` and ``removed`` places."""
    carried = [c for c in docs.columns if c not in ADDED]
    covered = repeated_lines(docs, id_col, text_col, window).withColumnsRenamed({"_id": "_jid", "_t": "_jt"})
    keyed = docs.select(*[F.col(f"`{c}`") for c in carried], *_key(id_col, text_col))
    joined = keyed.join(covered, F.col("_id").eqNullSafe(F.col("_jid")) & (F.col("_t") == F.col("_jt")), "left")
    text = F.col(f"`{text_col}`")
    # Places are sorted, so the ranges between them are what stays.
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("_covered")), lambda j: _between(F.col("_split"), F.get("_covered", j - 1), F.get("_covered", j))))
    cut = joined.withColumn("_split", F.split(text, "\n")).withColumn("_kept", F.when(F.size("_covered") > 0, kept))
    stays = F.exists("_kept", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    new_text = F.when(F.col("_kept").isNull(), text).when(stays, F.array_join("_kept", "\n")).otherwise("")
    return cut.select(
        *[(new_text if c == text_col else F.col(f"`{c}`")).alias(c) for c in carried],
        F.coalesce(F.size("_split"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("_covered").isNull(), F.lit(0)).otherwise(F.size("_covered")).cast("long").alias("n_removed"),
        F.coalesce("_covered", F.array().cast("array<int>")).alias("removed"),
    )


def _between(lines: Column, after: Column, before: Column) -> Column:
    """The lines after one removed place and before the next; a missing place stands for the text's start or end."""
    begin = F.coalesce(after + 1, F.lit(0))
    return F.slice(lines, begin + 1, F.coalesce(before, F.size(lines)) - begin)
