"""Benchmark decontamination with one Aho-Corasick automaton.

Test questions and answers are normalised and cut into windows of eight words; an item of fewer words is one window.
All windows go into one automaton, which reads each normalised document once.  The places of its matches are words of
the document, and only documents with a match pay for mapping words back to offsets of the original text.

Normalising works on UTF-8 bytes: one table lower-cases A-Z and turns every ASCII character outside 0-9a-zA-Z into a
space, while the bytes of other characters stay.  Bytes are scanned as Latin-1, which keeps them one to one.

The benchmark is a stated query set.  It is read in blocks of about ``BLOCK_BYTES`` of windows, written to the shared
folder.  One stage reads the documents in chunks of at most ``CHUNK_BYTES`` and holds one automaton at a time: with one
block it is built once a worker; with more, each block is built once a chunk, so a large benchmark costs time and not
memory.  Nothing is broadcast, nothing grows with the documents, and documents are never shuffled.

Defined results: a null text has no words; an item without words has no window; items with the same id are one item,
and a null id counts as the item ''; documents that repeat are judged alike; an empty benchmark leaves every document
clean; input columns with the names of added ones are replaced.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.storage import bounded_batches, open_fs, scratch_path

WINDOW = 8
#: An item counts as leaked with one window; a document is contaminated with this many items.
LEAST_ITEMS = 2
#: Bytes of windows to a block; an automaton takes some 35 times as much (README has figures).
BLOCK_BYTES = 4_000_000
#: Bytes of documents that wait for one block after the other.
CHUNK_BYTES = 64_000_000
ADDED = ("n_words", "n_hit", "n_items", "items", "spans", "contaminated")
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def normalised(found: list[bytes]) -> str:
    """Words with one space between and around them, a byte per character; '' without words."""
    return "" if not found else (b" " + b" ".join(found) + b" ").decode("latin-1")


def windows(text: str | None, window: int = WINDOW) -> set[str]:
    found = words(text)
    return {normalised(found[i : i + window]) for i in range(max(1, len(found) - window + 1))} if found else set()


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[dict[str, set[str]]]:
    """Windows with the items that hold them, in blocks of about ``block_bytes``; items stream to the driver."""
    block: dict[str, set[str]] = {}
    held = 0
    items = benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("i"), F.col(f"`{text_col}`").alias("t"))
    for row in items.toLocalIterator():
        for w in windows(row["t"]):
            ids = block.setdefault(w, set())
            if row["i"] not in ids:
                ids.add(row["i"])
                held += len(w) + len(row["i"])
        if held >= block_bytes:
            yield block
            block, held = {}, 0
    if block:
        yield block


class Scanner:
    """The automaton of one block."""

    def __init__(self, patterns: dict[str, set[str]]):
        import ahocorasick

        self.built = ahocorasick.Automaton()
        for w, ids in patterns.items():
            self.built.add_word(w, (w.count(" ") - 1, tuple(ids)))
        self.built.make_automaton()

    def scan(self, flat: str) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged ranges of hit words (first, behind the last) of a normalised text, and the items found."""
        ranges: list[list[int]] = []
        items: set[str] = set()
        at = seen = 0
        for end, (n, ids) in self.built.iter(flat):
            items.update(ids)
            at += flat.count(" ", seen, end + 1)  # spaces up to the match's end: one before each word, one behind the last
            seen = end + 1
            behind = at - 1
            first = behind - n
            while ranges and ranges[-1][1] >= first and ranges[-1][0] >= first:
                ranges.pop()
            if ranges and ranges[-1][1] >= first:
                ranges[-1][1] = max(ranges[-1][1], behind)
            else:
                ranges.append([first, behind])
        return [tuple(r) for r in ranges], items


_latest: list[tuple[str, Scanner]] = []


def scanner(path: str) -> Scanner:
    """The automaton of a written block; a worker holds one, the latest."""
    if not _latest or _latest[0][0] != path:
        _latest.clear()
        store, where = open_fs(path)
        with store.open_input_stream(where) as stream:
            patterns = pickle.loads(stream.read())
        _latest.append((path, Scanner(patterns)))
    return _latest[0][1]


#: The words of the original text, capitals included.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def offsets(text: str, ranges: list[tuple[int, int]]) -> list[int]:
    """Begin and end of each range of words as offsets of characters in the original text, one after the other."""
    firsts, lasts = {a: k for k, (a, _) in enumerate(ranges)}, {b - 1: k for k, (_, b) in enumerate(ranges)}
    out = [0] * (2 * len(ranges))
    for i, m in enumerate(_WORD.finditer(text)):
        if i in firsts:
            out[2 * firsts[i]] = m.start()
        if i in lasts:
            out[2 * lasts[i] + 1] = m.end()
    return out


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None, least_items: int = LEAST_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns (all by default) with ``n_words``, ``n_hit``, ``n_items``, the sorted ``items``, ``spans`` (begin
    and end offsets of hit ranges in the text) and ``contaminated``; no row goes."""
    spark = docs.sparkSession
    bounded_batches(spark)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ADDED]
    carried = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(kept)]
    out = docs.select(*carried, *([] if text_col in kept else [F.col(f"`{text_col}`").alias("_text")]))
    text = f"_k{kept.index(text_col)}" if text_col in kept else "_text"
    folder, written = scratch_path(spark, "benchmark"), []
    store, where = open_fs(folder)
    for block in blocks(benchmark, id_col, item_text_col, block_bytes):
        store.create_dir(where, recursive=True)
        with store.open_output_stream(f"{where}/{len(written)}.windows", compression=None) as stream:
            stream.write(pickle.dumps(block))
        written.append(f"{folder}/{len(written)}.windows")
    fields = T.StructType.fromDDL("n_words long, n_hit long, items array<string>, spans array<int>").fields
    schema = T.StructType([*(f for f in out.schema.fields if f.name != "_text"), *fields])
    found = out.mapInArrow(_scan(written, text), schema)
    return found.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)],
        "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans", (F.size("items") >= least_items).alias("contaminated"),
    )


def _scan(written: list[str], text_name: str):
    def judged(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [batch.column(text_name).to_pylist() for batch in held]
        flat = [[normalised(words(t)) for t in part] for part in texts]
        ranges = [[[] for _ in part] for part in texts]
        items: list[list[set[str]]] = [[set() for _ in part] for part in texts]
        for path in written:
            of = scanner(path)
            for k, part in enumerate(flat):
                for i, one in enumerate(part):
                    hit, ids = of.scan(one)
                    if ids:
                        ranges[k][i] = merge([*ranges[k][i], *hit])
                        items[k][i] |= ids
        for k, batch in enumerate(held):
            kept = [n for n in batch.schema.names if n != "_text"]
            spans = [offsets(t, r) if r else [] for t, r in zip(texts[k], ranges[k])]
            columns = [
                *[batch.column(n) for n in kept], pa.array([max(0, t.count(" ") - 1) for t in flat[k]], pa.int64()), pa.array([sum(b - a for a, b in r) for r in ranges[k]], pa.int64()),
                pa.array([sorted(s) for s in items[k]], pa.list_(pa.string())), pa.array(spans, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_words", "n_hit", "items", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if len(written) < 2 or size >= CHUNK_BYTES:
                yield from judged(held)
                held, size = [], 0
        if held:
            yield from judged(held)

    return run


def excise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Cut the spans out of the text, leaving a space for each."""
    bounds = F.sequence(F.lit(0), (F.size("spans") / 2).cast("int"))

    def piece(i):
        begin = F.coalesce(F.get("spans", 2 * i - 1), F.lit(0))
        return F.substring(F.col(f"`{text_col}`"), begin + 1, F.coalesce(F.get("spans", 2 * i), F.length(f"`{text_col}`")) - begin)

    cut = F.trim(F.array_join(F.transform(bounds, piece), " "))
    return docs.withColumn(text_col, F.when(F.size("spans") > 0, cut).otherwise(F.col(f"`{text_col}`")))
