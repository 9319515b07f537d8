"""Paged search results as a data source, and fetching with an injected client.

``fetch(query, page)`` returns the results of a page as dicts; an empty page ends a query.  Queries are dealt over a
few lanes, each a partition that reads its queries page by page.  A lane waits as many times the interval of the rate
as there are lanes, so the rate holds for all of them together.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siltstone.storage import bounded_batches

SCHEMA = "query string, page int, position int, url string, title string"
Fetch = Callable[[str, int], list[dict]]


#: Lanes in which queries are asked side by side.
LANES = 8


class Lane(InputPartition):
    def __init__(self, queries: list[str]):
        self.queries = queries


class SearchReader(DataSourceReader):
    def __init__(self, options: dict[str, str], fetch: Fetch):
        queries: list[str] = json.loads(options["queries"])
        n = min(LANES, len(queries))
        self.lanes = [Lane(queries[i::n]) for i in range(n)]
        self.pages = int(options.get("pages", 50))
        self.wait = 0.0 if options.get("rate") is None else n / max(float(options["rate"]), 0.1)
        self.fetch = fetch

    def partitions(self) -> list[InputPartition]:
        return self.lanes

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for text in partition.queries:
            for page in range(self.pages):
                found = self.fetch(text, page)
                time.sleep(self.wait)
                if not found:
                    break
                for i, x in enumerate(found):
                    yield text, page, i, x.get("url"), x.get("title")


def search_source(fetch: Fetch) -> type[DataSource]:
    """A data source ``search`` bound to a client; register it, then read with options queries, pages and rate."""

    class Search(DataSource):
        @classmethod
        def name(cls) -> str:
            return "search"

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return SearchReader(self.options, fetch)

    return Search


def search(spark: SparkSession, fetch: Fetch, queries: list[str], pages: int = 50, rate: float | None = None) -> DataFrame:
    spark.dataSource.register(search_source(fetch))
    reader = spark.read.format("search").option("queries", json.dumps(queries)).option("pages", pages)
    return (reader if rate is None else reader.option("rate", rate)).load()


def fixture_pages(root: str) -> Fetch:
    """Offline results: ``root/<query>/<page>.json`` holds a list of results."""

    def fetch(query: str, page: int) -> list[dict]:
        from pathlib import Path

        p = Path(root, query, f"{page}.json")
        return json.loads(p.read_text()) if p.exists() else []

    return fetch


def fetch_payloads(df: DataFrame, build: Callable[[], Callable[[str], tuple[bytes, str] | None]], url: str = "url") -> DataFrame:
    """Adds ``content`` and ``content_type``; only images count, and any failure leaves both null."""
    schema = T.StructType([*df.schema.fields, T.StructField("content", T.BinaryType()), T.StructField("content_type", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = build()

        def one(u):
            try:
                got = get(u) if u else None
            except Exception:  # the client is injected; any failure is a failed attempt
                got = None
            return got if got is not None and got[1].lower().startswith("image/") else (None, None)

        for pdf in batches:
            pairs = [one(u) for u in pdf[url]]
            yield pdf.assign(content=[b for b, _ in pairs], content_type=[None if t is None else t.lower() for _, t in pairs])

    bounded_batches(df.sparkSession, rows=64)
    return df.mapInPandas(run, schema)


def requests_for(quotas: DataFrame, suffix: str) -> DataFrame:
    """(name, query text) of each quota row, best bands first."""
    from siltstone.functions.scalars import query_text

    return quotas.select("Name", query_text(F.col("Name"), suffix).alias("query"), "band_label", "Ranking", "q_r_base")
