"""Files as output: payload copies, masks and tar shards, written by the executors through any file system.

A file is written under a temporary name and renamed, so a task that runs twice leaves one whole file.
"""

from __future__ import annotations

import json
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.scalars import list_of, number, parse_size, suffix_of, text
from siltstone.functions.vocabulary import SHARD_EXTENSIONS
from siltstone.storage import bounded_batches, open_fs

STATUS = pa.schema([("path", pa.string()), ("status", pa.string()), ("length", pa.int64())])


def put(store: fs.FileSystem, path: str, data: bytes) -> None:
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    fresh = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(fresh, compression=None) as out:
        out.write(data)
    store.move(fresh, path)


def write_files(df: DataFrame, root: str, name: Column, content: Column, replace: bool = True) -> DataFrame:
    """Write each row's bytes to ``root/name``; returns (path, status, length) with status saved, duplicate_existing,
    missing (no bytes) or io_error.  Evaluate it once: each evaluation writes."""
    bounded_batches(df.sparkSession, rows=64, megabytes=64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_fs(root)
        for batch in batches:
            rows = []
            for n, data in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                path = f"{base}/{n}"
                if data is None:
                    status = "missing"
                elif not replace and store.get_file_info(path).type == fs.FileType.File:
                    status = "duplicate_existing"
                else:
                    try:
                        put(store, path, data)
                        status = "saved"
                    except OSError:
                        status = "io_error"
                rows.append((n, status, len(data or b"")))
            yield pa.RecordBatch.from_pydict({"path": [r[0] for r in rows], "status": [r[1] for r in rows], "length": [r[2] for r in rows]}, schema=STATUS)

    return df.select(name.alias("name"), content.alias("content")).mapInArrow(run, "path string, status string, length long")


def quarantine_name(band: Column, species: Column, path: Column) -> Column:
    return F.concat_ws("/", F.lit("nsfw"), band, species, F.element_at(F.split(path, "/"), -1))


def sample_metadata(df: DataFrame) -> DataFrame:
    """Adds ``key``, ``caption``, ``meta`` (JSON with its nulls; ``phash`` only where there is one) and ``ext``."""
    size = parse_size(F.col("image_size"))
    blank = F.lit("")
    fields = [
        text(F.col("image_id")).alias("image_id"), text(F.col("split")).alias("split"), F.coalesce(F.trim("source_url"), blank).alias("source_url"), size["w"].alias("width"), size["h"].alias("height"),
        number(F.col("ae_relevance")).alias("ae_relevance"), number(F.col("ae_aesthetic")).alias("ae_aesthetic"), text(F.col("species")).alias("species"), list_of(F.col("species")).alias("species_list"), text(F.col("tags")).alias("tags"),
    ]
    plain = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    hashed = F.to_json(F.struct(*fields, text(F.col("phash")).alias("phash")), {"ignoreNullFields": "false"})
    ext = suffix_of(F.col("path"))
    return df.withColumns({"key": text(F.col("image_id")), "caption": text(F.col("hybrid_caption")), "meta": F.when(text(F.col("phash")) != "", hashed).otherwise(plain), "ext": F.when(ext.isin(*SHARD_EXTENSIONS), ext).otherwise(".jpg")})


def tar_entry(name: str, data: bytes) -> bytes:
    """A file as its blocks in a tar archive; an open ``TarFile`` would keep a list of all its members."""
    info = tarfile.TarInfo(name)
    info.size, info.mtime = len(data), 0
    return info.tobuf(tarfile.USTAR_FORMAT) + data + bytes(-len(data) % tarfile.BLOCKSIZE)


def tar_end(length: int) -> bytes:
    """What ends an archive of that many bytes: two empty blocks, and more to a whole record."""
    return bytes(2 * tarfile.BLOCKSIZE + -(length + 2 * tarfile.BLOCKSIZE) % tarfile.RECORDSIZE)


def write_shards(df: DataFrame, root: str, pattern: str, n_shards: int) -> DataFrame:
    """Pack rows (shard, position, key, ext, content, caption, meta) into one tar a shard: (path, samples, bytes).

    Rows are dealt by shard and sorted by place; a shard streams to its file sample by sample, so a task holds one
    batch.  Shard sizes are bounded by their sample count, which is what keeps them even.
    """
    bounded_batches(df.sparkSession, rows=64, megabytes=64)
    columns = ("shard", "key", "ext", "content", "caption", "meta")
    schema = pa.schema([("path", pa.string()), ("samples", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_fs(root)
        current, out, fresh, n = None, None, "", 0

        def close() -> pa.RecordBatch:
            out.write(tar_end(out.tell()))
            out.close()
            path = f"{base}/{pattern % current}"
            store.move(fresh, path)
            return pa.RecordBatch.from_pydict({"path": [pattern % current], "samples": [n], "bytes": [store.get_file_info(path).size]}, schema=schema)

        for batch in batches:
            for shard, key, ext, content, caption, meta in zip(*(batch.column(c).to_pylist() for c in columns)):
                if shard != current:
                    if out is not None:
                        yield close()
                    current, n = shard, 0
                    fresh = f"{base}/{pattern % shard}.{uuid.uuid4().hex}.tmp"
                    store.create_dir(fresh.rsplit("/", 1)[0], recursive=True)
                    out = store.open_output_stream(fresh, compression=None, buffer_size=1 << 20)
                for name, data in ((key + ext, content), (key + ".txt", caption.encode()), (key + ".json", meta.encode())):
                    out.write(tar_entry(name, data))
                n += 1
        if out is not None:
            yield close()

    dealt = df.select(*columns, "position").repartitionByRange(max(1, n_shards), "shard").sortWithinPartitions("shard", "position")
    return dealt.mapInArrow(run, "path string, samples long, bytes long")


def clear_shards(spark, root: str, patterns: tuple[str, ...] = ("train/train-*.tar", "val/val-*.tar")) -> int:
    """Delete the shards of an earlier run; returns how many there were."""
    jvm, n = spark._jvm, 0
    for pattern in patterns:
        where = jvm.org.apache.hadoop.fs.Path(f"{root}/{pattern}")
        store = where.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in store.globStatus(where) or []:
            store.delete(found.getPath(), False)
            n += 1
    return n


def split_stats(totals: dict[str, int], manifests: dict[str, tuple[str, int, str]]) -> str:
    """The statistics file of a packed dataset."""
    ids = {s: {"path": p, "count": n, "sha256": d} for s, (p, n, d) in manifests.items()}
    return json.dumps({**totals, "ids": ids}, indent=2)
