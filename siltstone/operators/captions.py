"""Caption stages: screening, upsert of corrected captions, composition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.documents import compose, is_nameless, parse
from siltstone.functions.scalars import is_blank, text
from siltstone.operators.ledger import choose_key, ensure_columns, require_columns, split_by


def screen(df: DataFrame, tags: str = "tags") -> tuple[DataFrame, DataFrame]:
    """(kept, flagged): flagged rows have tags without any name, or tags that do not parse."""
    flagged, kept = split_by(require_columns(df, tags), is_nameless(F.col(tags)))
    return kept, flagged


def recap_rows(flagged: DataFrame, columns: tuple[str, ...] = ("path", "image_id", "caption", "tags"), blank: tuple[str, ...] = ("caption", "tags")) -> DataFrame:
    """What is to be captioned again: the named columns only, with the old results blanked."""
    out = ensure_columns(flagged, **dict.fromkeys(columns, "string"))
    return out.select(*[F.lit("").alias(c) if c in blank else F.col(c) for c in columns])


def upsert(base: DataFrame, fresh: DataFrame, key: str | None = None, columns: tuple[str, ...] = ("caption", "tags"), only_missing: bool = False, require_all: bool = False, order: Column | None = None) -> DataFrame:
    """Takes each new value that is not blank, column by column; unmatched rows stay as they are.

    Repeated keys in ``fresh`` would multiply rows, so each column keeps its last value that is not blank (by
    ``order``, else the greatest).  ``only_missing`` fills blanks only; ``require_all`` takes nothing unless every
    new column has a value.
    """
    k = choose_key(base, fresh, key=key)
    rank = order if order is not None else F.lit(0)
    picks = [F.max_by(F.col(c), F.when(~is_blank(F.col(c)), F.struct(rank, F.col(c)))).alias(f"_new_{c}") for c in columns]
    new = fresh.groupBy(F.col(k).alias("_k")).agg(*picks)
    out = ensure_columns(base, **dict.fromkeys(columns, "string")).join(new, F.col(k) == F.col("_k"), "left")
    there = {c: ~is_blank(F.col(f"_new_{c}")) for c in columns}
    whole = F.lit(True)
    for c in columns if require_all else ():
        whole = whole & there[c]
    take = {c: whole & there[c] & (is_blank(F.col(c)) if only_missing else F.lit(True)) for c in columns}
    return out.withColumns({c: F.when(take[c], F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}).drop("_k", *[f"_new_{c}" for c in columns])


def hybrid_captions(df: DataFrame, caption: str = "caption", tags: str = "tags", out: str = "hybrid_caption") -> DataFrame:
    """Adds the composed caption; the document is parsed once in a projection of its own."""
    require_columns(df, caption, tags)
    return df.withColumn("_doc", parse(F.col(tags))).withColumn(out, compose(text(F.col(caption)), F.col("_doc"))).drop("_doc")


def last_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))).where("_n = 1").drop("_n")
