"""Tables as input: CSV with declared types, quotas, id lists, attempt logs and file listings."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.scalars import band_of, blank_to_null, stem_of, suffix_of
from siltstone.operators.ledger import require_columns
from siltstone.storage import open_fs

ATTEMPTS = "ts string, status string, url string, scrape_run_id string, species string, rank int, band string, query string, hash string, path string, fmt string, w int, h int, content_type string, error string"
MEMBERS = pa.schema([("path", pa.string()), ("name", pa.string()), ("length", pa.int64())])


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",", blanks: bool = False, multi_line: bool = True) -> DataFrame:
    """CSV, types declared and never inferred; blanks are null unless asked for.

    With quoted line breaks (``multi_line``) a file is one task; without, large files are split.
    """
    reader = spark.read.schema(schema).option("header", True).option("multiLine", multi_line).option("escape", '"').option("sep", sep)
    df = reader.option("mode", "PERMISSIVE").csv(path)
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.coalesce(c, F.lit("")) if blanks else blank_to_null(F.col(c)) for c in texts}) if texts else df


def read_text_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns of the header as text with blanks kept; only the header is read to learn their names."""
    names = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path).columns
    return read_csv(spark, path, T.StructType([T.StructField(n, T.StringType()) for n in names]), sep, blanks=True)


def read_quotas(spark: SparkSession, path: str) -> DataFrame:
    """Ranking, Name, q_r_base and band with the normalised ``band_label``, ordered by band and rank."""
    return normalise_quotas(read_text_csv(spark, path))


def normalise_quotas(df: DataFrame) -> DataFrame:
    require_columns(df, "Ranking", "Name", "q_r_base", "band")
    typed = df.withColumns({"Ranking": F.col("Ranking").cast("int"), "q_r_base": F.col("q_r_base").cast("int"), "band_label": band_of(F.col("band"))})
    return typed.orderBy("band_label", "Ranking")


def limit_quotas(quotas: DataFrame, band: str | None = None, name: str | None = None, limit: int | None = None) -> DataFrame:
    """One band or name only, and no quota above ``limit``."""
    out = quotas
    if band not in (None, "all"):
        out = out.where(F.col("band_label") == band)
    if name is not None:
        out = out.where(F.lower("Name") == name.lower())
    return out if limit is None else out.withColumn("q_r_base", F.least("q_r_base", F.lit(limit)))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids, one a line, trimmed, distinct and in order."""
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id <> ''").distinct().orderBy("id")


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """An append-only log of attempts as JSON lines with ragged keys."""
    return spark.read.schema(ATTEMPTS).json(path)


def read_payloads(spark: SparkSession, path: str, glob: str = "*", content: bool = True) -> DataFrame:
    """Files below a folder: path, length and (if asked for) content; without content only the listing is read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return df.select("path", "length", *(["content"] if content else []))


def read_members(spark: SparkSession, path: str, glob: str = "*.tar") -> DataFrame:
    """Members of the tar archives below a folder: path, name, length.

    An archive is read by one task, header by header, and its list of members is emptied as it goes: memory does not
    grow with the archive, which may be larger than a binary value can be.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, within = open_fs(path)
                rows: list[tuple[str, int]] = []
                with io.BufferedReader(store.open_input_file(within), 1 << 18) as stream, tarfile.open(fileobj=stream, mode="r:") as tar:
                    while (member := tar.next()) is not None:
                        tar.members.clear()
                        rows.append((member.name, member.size))
                        if len(rows) == 5_000:
                            yield told(path, rows)
                            rows = []
                yield told(path, rows)

    def told(path: str, rows: list[tuple[str, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": [path] * len(rows), "name": [r[0] for r in rows], "length": [r[1] for r in rows]}, schema=MEMBERS)

    return read_payloads(spark, path, glob, content=False).select("path").mapInArrow(run, "path string, name string, length long")


def by_extension(path: Column, ranks: dict[str, int]) -> Column:
    s, out = suffix_of(path), F.lit(max(ranks.values()) + 1)
    for ext, rank in ranks.items():
        out = F.when(s == ext, F.lit(rank)).otherwise(out)
    return out


def resolve_ids(ids: DataFrame, listing: DataFrame, id_col: str = "image_id", ranks: dict[str, int] | None = None, preferred: Column | None = None) -> DataFrame:
    """Adds ``path``: the file whose stem is the id, preferred folders first, then by extension, then by path."""
    order = by_extension(F.col("path"), ranks or {".png": 0, ".jpg": 1, ".jpeg": 1, ".webp": 2})
    far = F.when(preferred, 0).otherwise(1) if preferred is not None else F.lit(0)
    w = Window.partitionBy("_stem").orderBy(far, order, "path")
    best = listing.select("path").withColumn("_stem", stem_of(F.col("path"))).withColumn("_n", F.row_number().over(w)).where("_n = 1").select("_stem", "path")
    return ids.drop("path").join(best, F.col(id_col) == F.col("_stem"), "left").drop("_stem")


def masks_with_images(listing: DataFrame, suffix: str = "_mask.png") -> DataFrame:
    """(mask, image): masks with the sibling image of the same stem, by extension png, jpg, jpeg, webp, bmp."""
    ranks = {".png": 0, ".jpg": 1, ".jpeg": 2, ".webp": 3, ".bmp": 4}
    masks = listing.where(F.col("path").endswith(suffix)).select(F.col("path").alias("mask"), F.expr(f"left(path, length(path) - {len(suffix)})").alias("_base"))
    rest = listing.where(~F.col("path").endswith(suffix)).select("path", F.regexp_replace("path", r"\.[^./]+$", "").alias("_base"), by_extension(F.col("path"), ranks).alias("_r")).where(f"_r < {len(ranks)}")
    best = rest.groupBy("_base").agg(F.min_by("path", "_r").alias("image"))
    return masks.join(best, "_base").select("mask", "image")
