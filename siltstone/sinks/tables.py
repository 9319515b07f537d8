"""Tables as output: versions with a pointer, CSV exports, logs and audits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.storage import materialize, scratch_path


def write_version(df: DataFrame, root: str, run_id: str | None = None) -> str:
    """Write a new version below ``root`` and point ``CURRENT`` at it; what is being read is never overwritten.

    The pointer is written beside and renamed over the old one in one step where the file system can do that, as HDFS
    and local ones can, so readers see the old version or the new one.
    """
    run = run_id or uuid.uuid4().hex
    path = f"{root}/run_id={run}"
    df.write.mode("errorifexists").parquet(path)
    spark = df.sparkSession
    fs, jvm = _fs(spark, root)
    fresh = jvm.org.apache.hadoop.fs.Path(f"{root}/.CURRENT-{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(run.encode()))
    out.close()
    pointer = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{root}/CURRENT"))
    overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    overwrite[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(fresh), pointer, overwrite)
    return path


def read_version(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    run = run_id or spark.read.text(f"{root}/CURRENT").first()[0]
    return spark.read.parquet(f"{root}/run_id={run}")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), jvm


def as_text(df: DataFrame) -> DataFrame:
    """CSV form: nulls blank, booleans TRUE and FALSE, nested columns as JSON with their nulls."""
    def cell(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            c = F.when(c, "TRUE").otherwise(F.when(~c, "FALSE"))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            c = F.to_json(c, {"ignoreNullFields": "false"})
        return F.coalesce(c.cast("string"), F.lit("")).alias(f.name)

    return df.select(*[cell(f) for f in df.schema])


def export_csv(df: DataFrame, path: str, sep: str = ",", single: bool = False) -> None:
    """CSV with a header; ``single`` for reports that people open as one file."""
    out = as_text(df)
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).option("escape", '"').option("sep", sep).option("emptyValue", "").csv(path)


def append_log(df: DataFrame, path: str, ts: str | None = None) -> None:
    """Append JSON lines; rows without a time get the present one."""
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'") if ts is None else F.lit(ts)
    out = df.withColumn("ts", F.coalesce("ts", stamp)) if "ts" in df.columns else df.withColumn("ts", stamp)
    out.write.mode("append").json(path)


def append_audit(df: DataFrame, path: str, stage: str, run_id: str) -> None:
    """Audit rows by stage and run; a rerun replaces its own partition instead of adding rows again."""
    out = df.drop("stage", "run_id").withColumns({"stage": F.lit(stage), "run_id": F.lit(run_id)})
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stage", "run_id").parquet(path)


def write_ids(df: DataFrame, path: str) -> None:
    df.select(F.col(df.columns[0]).cast("string")).write.mode("overwrite").text(path)


def checkpointed(df: DataFrame, results: str, key: str, compute, every: int = 20) -> DataFrame:
    """Resumable work: rows without a result are computed in slices that are appended as they end.

    A job that stops in between keeps the slices it wrote; the next call only computes what is missing.  ``every`` is
    the number of rows after which results are stored, on average; slices are made once, as partitions of a table.
    """
    spark = df.sparkSession
    fs, jvm = _fs(spark, results)
    done = spark.read.parquet(results) if fs.exists(jvm.org.apache.hadoop.fs.Path(results)) else None
    left = df if done is None else df.join(done.select(key).distinct(), key, "left_anti")
    left = materialize(left, "pending")
    slices = max(1, -(-left.count() // every))
    path = scratch_path(spark, "slices")
    left.withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")).repartition("_slice").write.partitionBy("_slice").parquet(path)
    dealt = spark.read.parquet(path)
    for (i,) in dealt.select("_slice").distinct().orderBy("_slice").collect():  # one number a slice
        compute(dealt.where(F.col("_slice") == i).select(*left.columns)).write.mode("append").parquet(results)
    return spark.read.parquet(results)
