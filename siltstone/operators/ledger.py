"""The record ledger: schema guards, keys, flags by score or by key, upserts and their audit trail.

Flags are booleans that a left join on distinct keys sets; nothing is updated in place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.scalars import best_score, blank_to_null, hit_text, is_blank, md5_in, ranked_hits, text, truthy
from siltstone.functions.vocabulary import DROP_COLUMNS, LEDGER_COLUMNS, UNSAFE_TAGS


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def ensure_columns(df: DataFrame, **types: str) -> DataFrame:
    """Adds what is missing as nulls of the given type."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in types.items() if n not in df.columns})


def ledger_rows(df: DataFrame) -> DataFrame:
    """The ledger's base columns in their order; absent ones are blank."""
    return ensure_columns(df, **dict.fromkeys(LEDGER_COLUMNS, "string")).select(*LEDGER_COLUMNS)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(key).count().where("count > 1")


def choose_key(base: DataFrame, other: DataFrame, preferred: tuple[str, ...] = ("image_id", "path"), key: str | None = None) -> str:
    """The first column of ``preferred`` that both sides have, unless one is named."""
    for name in (key,) if key else preferred:
        if name in base.columns and name in other.columns:
            return name
    raise ValueError(f"no common key among {(key,) if key else preferred}")


def anti_filter(df: DataFrame, *flags: str) -> DataFrame:
    """Rows with none of the flags; a missing flag is not set."""
    return df.where(reduce(lambda a, b: a & b, [~truthy(F.col(f)) for f in flags]))


def split_by(df: DataFrame, mask: Column) -> tuple[DataFrame, DataFrame]:
    """(rows with, rows without); a null mask counts as without."""
    m = F.coalesce(mask, F.lit(False))
    return df.where(m), df.where(~m)


def flag_by_score(df: DataFrame, scores: str, threshold: float = 0.5, tags: tuple[str, ...] = UNSAFE_TAGS, out: str = "is_unsafe") -> DataFrame:
    """Sets ``out`` where the best score of the named tags reaches the threshold; keeps score and hits beside it."""
    hits = ranked_hits(F.col(scores), tags)
    scored = df.withColumn("_hits", hits).withColumn(f"{out}_score", best_score(F.col("_hits")))
    return scored.withColumn(f"{out}_tags", hit_text(F.col("_hits"))).withColumn(out, F.col(f"{out}_score") >= threshold).drop("_hits")


def keyed_update(df: DataFrame, results: DataFrame, key: str, fallback: str, columns: list[str]) -> DataFrame:
    """Results by ``key``, or by ``fallback`` where the row has no key; rows without a result keep what they had."""
    cols = [c for c in columns]
    right = results.select(F.when(is_blank(F.col(key)), F.concat(F.lit("p:"), F.col(fallback))).otherwise(F.concat(F.lit("k:"), F.col(key))).alias("_k"), F.struct(*cols).alias("_new")).groupBy("_k").agg(F.max_by("_new", F.to_json("_new")).alias("_new"))
    left = ensure_columns(df, **{c: results.schema[c].dataType.simpleString() for c in cols})
    left = left.withColumn("_k", F.when(is_blank(F.col(key)), F.concat(F.lit("p:"), F.col(fallback))).otherwise(F.concat(F.lit("k:"), F.col(key))))
    out = left.join(right, "_k", "left")
    return out.withColumns({c: F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)) for c in cols}).drop("_k", "_new")


def drop_log(df: DataFrame, flag: str, stage: str, reason: str, run: str) -> DataFrame:
    """Audit rows of flagged records; keyed by run, so that a rerun can replace its own rows."""
    rows = ensure_columns(df.where(F.col(flag)), **dict.fromkeys(DROP_COLUMNS, "string"))
    return rows.withColumns({"stage": F.lit(stage), "drop_reason": F.lit(reason), "run_id": F.lit(run)}).select(*DROP_COLUMNS, "run_id")


def mark_by_keys(df: DataFrame, keys: DataFrame, key: str, flag: str, keep_old: bool = True) -> DataFrame:
    """Sets ``flag`` on rows whose key is in ``keys``; other rows keep their flag, or lose it."""
    hit = keys.select(F.col(key).alias("_id")).where("_id IS NOT NULL").distinct().withColumn("_hit", F.lit(True))
    old = truthy(F.col(flag)) if flag in df.columns and keep_old else F.lit(False)
    return df.join(hit, F.col(key) == F.col("_id"), "left").withColumn(flag, F.coalesce("_hit", old)).drop("_id", "_hit")


def unflag_by_keys(df: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """Clears ``flag`` on rows whose key is in ``keys``, whatever the letter case."""
    ids = keys.select(F.lower(text(F.col(key))).alias("_id")).where("_id <> ''").distinct().withColumn("_hit", F.lit(True))
    out = df.join(ids, F.lower(text(F.col(key))) == F.col("_id"), "left")
    return out.withColumn(flag, F.when(F.col("_hit"), F.lit(False)).otherwise(truthy(F.col(flag)))).drop("_id", "_hit")


def id_set(*sources: DataFrame | list[str], spark=None) -> DataFrame:
    """Distinct trimmed ids of all sources (tables with one text column, or lists), in order."""
    frames = [s.select(F.trim(F.col(s.columns[0])).alias("id")) if isinstance(s, DataFrame) else spark.createDataFrame([(x.strip(),) for x in s], "id string") for s in sources]
    return reduce(DataFrame.unionByName, frames).where("id <> ''").distinct().orderBy("id")


def hashes_in(tokens: DataFrame) -> DataFrame:
    """Distinct MD5 hashes within free text, sorted."""
    return tokens.select(md5_in(F.col(tokens.columns[0])).alias("id")).where("id IS NOT NULL").distinct().orderBy("id")


def withdraw_drops(drops: DataFrame, hashes: DataFrame, stage: str) -> tuple[DataFrame, DataFrame]:
    """(remaining, withdrawn) audit rows: rows of ``stage`` go whose id is a hash, or whose path holds one.

    The path is searched by its own hashes, so both tests are equi-joins on short keys instead of a nested loop; rows
    with the same id and path share their fate, so these two are the key, and no row number has to be made up.
    """
    ids = hashes.select(F.lower("id").alias("_h")).distinct()
    keys = drops.where(F.col("stage") == stage).select(F.col("image_id").alias("_i"), F.col("path_raw").alias("_p")).distinct()
    within = F.regexp_extract_all(F.lower(F.coalesce("_p", F.lit(""))), F.lit("(?=([a-f0-9]{32}))"), F.lit(1))
    hit = keys.select("_i", "_p", F.explode(F.array_distinct(F.concat(F.array(F.lower(F.coalesce("_i", F.lit("")))), within))).alias("_h")).join(ids, "_h", "left_semi").select("_i", "_p").distinct()
    marked = drops.join(hit.withColumn("_hit", F.lit(True)), F.col("image_id").eqNullSafe(F.col("_i")) & F.col("path_raw").eqNullSafe(F.col("_p")), "left")
    gone, left = split_by(marked, F.col("_hit") & (F.col("stage") == stage))
    return left.select(*drops.columns), gone.select(*drops.columns)


def clear_columns(df: DataFrame, keys: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Nulls ``columns`` on rows whose key is in ``keys``."""
    ids = keys.select(F.lower(F.col(keys.columns[0])).alias("_id")).distinct().withColumn("_hit", F.lit(True))
    out = df.join(ids, F.lower(F.col(key)) == F.col("_id"), "left")
    return out.withColumns({c: F.when(F.col("_hit").isNull(), F.col(c)) for c in columns}).drop("_id", "_hit")


def pending(df: DataFrame, output: str, overwrite: bool = False) -> DataFrame:
    """Rows still to be processed: those whose output is blank, or all."""
    return df if overwrite else df.where(is_blank(F.col(output)))


def not_done(df: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Resume: rows without a row in the results table."""
    return df.join(results.select(key).distinct(), key, "left_anti")


def first_seen(df: DataFrame, group: str, url: str, order: str) -> DataFrame:
    """The first record of each URL of a group; blank URLs never count."""
    w = Window.partitionBy(group, url).orderBy(order)
    return df.where(~is_blank(F.col(url))).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def quota_take(df: DataFrame, quotas: DataFrame, group: str, order: str, present: DataFrame | None = None) -> DataFrame:
    """The first ``q_r_base`` records of each group in arrival order, less what is present already."""
    have = present.groupBy(group).agg(F.count(F.lit(1)).alias("_have")) if present is not None else None
    need = quotas.select(group, F.col("q_r_base").alias("_need"))
    if have is not None:
        need = need.join(have, group, "left").select(group, F.greatest(F.lit(0), F.col("_need") - F.coalesce("_have", F.lit(0))).alias("_need"))
    most = need.agg(F.max("_need")).first()[0] or 0  # a constant bound lets each task keep its best rows of a group before the shuffle
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("_n") <= most)
    return ranked.join(need, group).where("_n <= _need").drop("_n", "_need")


def quota_total(quotas: DataFrame, need: str = "q_r_base") -> DataFrame:
    """One row: how many groups there are and how many records they ask for in all."""
    return quotas.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.greatest(F.lit(0), F.col(need))), F.lit(0)).cast("long").alias("target"))


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first rows of what a command would change, for a dry run."""
    return df.orderBy(*order).limit(n)


def attempt_status(fetched: Column, valid: Column, exists: Column, error: Column) -> Column:
    """What became of one attempt to fetch a record."""
    return F.when(~F.coalesce(fetched, F.lit(False)), "http_fail").when(~F.coalesce(valid, F.lit(False)), "invalid_or_corrupt").when(F.coalesce(exists, F.lit(False)), "duplicate_existing").when(blank_to_null(error).isNotNull(), "io_error").otherwise("saved")


def status_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def single_row(df: DataFrame, path_col: str, wanted: str) -> DataFrame:
    """The row of one file by relative path, or by stem where exactly one row has it; otherwise none."""
    from siltstone.functions.scalars import stem_of

    exact = df.where(F.col(path_col) == wanted)
    by_stem = df.where(stem_of(F.col(path_col)) == stem_of(F.lit(wanted)))
    for found in (exact, by_stem):
        if len(found.limit(2).collect()) == 1:
            return found
    return df.limit(0)


def upsert_row(df: DataFrame, row: DataFrame, key: str) -> DataFrame:
    """Replace or add the rows of a small table by key."""
    return df.join(row.select(key), key, "left_anti").unionByName(row, allowMissingColumns=True)
