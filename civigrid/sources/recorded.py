"""Catalogue searches and layer metadata as Spark data sources.

``catalog_search`` gives hits of search texts, ``layer_metadata`` gives bodies by address. Both take a transport: a
folder of recorded answers (``recorded``), or ``live`` requests from the executors. A reader is one partition for each
slice of the asked texts.
"""

from __future__ import annotations

import hashlib
import http.client
import json
import os
import urllib.parse
import urllib.request

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from civigrid.operators.fields import METADATA

HIT = "id string, title string, type string, url string, owner string, description string, snippet string, tags array<string>, access string, created bigint, modified bigint, typeKeywords array<string>"
ANSWER = f"total bigint, start bigint, num bigint, nextStart bigint, results array<struct<{', '.join(x.strip().replace(' ', ':', 1) for x in HIT.split(', '))}>>"
MOST_HITS, USUAL_HITS = 100, 50


def hits_asked(limit: int | None) -> int:
    """Hits of a search: one page, 50 unless told otherwise, never over 100."""
    return min(USUAL_HITS if limit is None else limit, MOST_HITS)


def recorded_name(key: str) -> str:
    """The file that holds the recorded answer to a request."""
    return hashlib.sha256(key.encode()).hexdigest()[:32] + ".json"


def record(folder: str, key: str, body: str) -> None:
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, recorded_name(key)), "w", encoding="utf-8") as f:
        f.write(body)


def answer(options: dict, key: str, url: str) -> str | None:
    """A request's body, null if it fails or wasn't recorded."""
    if folder := options.get("recorded"):
        try:
            with open(os.path.join(folder, recorded_name(key)), encoding="utf-8") as f:
                return f.read()
        except OSError:
            return None
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": "application/json"}), timeout=30) as r:  # noqa: S310
            return r.read().decode("utf-8-sig", "replace")
    except (OSError, ValueError, http.client.HTTPException):  # an address that can't be asked for is a failed request
        return None


class _Slice(InputPartition):
    def __init__(self, asked: list[str]):
        self.asked = asked


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[_Slice]:
        asked = json.loads(self.options.get("asked", "[]"))
        n = max(1, int(self.options.get("slice", "16")))
        return [_Slice(asked[i : i + n]) for i in range(0, len(asked), n)] or [_Slice([])]

    def read(self, partition: _Slice):
        for key in partition.asked:
            yield key, answer(self.options, key, self.address(key))

    def address(self, key: str) -> str:
        raise NotImplementedError


class _SearchReader(_Reader):
    def address(self, key: str) -> str:
        limit = self.options.get("limit")
        query = urllib.parse.urlencode({"q": key, "num": hits_asked(int(limit) if limit else None), "start": 1, "f": "json"})
        return f"{self.options.get('endpoint', '')}?{query}"


class _MetadataReader(_Reader):
    def address(self, key: str) -> str:
        return key + ("&f=json" if "?" in key else "?f=json")


class CatalogSearch(DataSource):
    @classmethod
    def name(cls) -> str:
        return "catalog_search"

    def schema(self) -> str:
        return "query string, body string"

    def reader(self, schema) -> DataSourceReader:
        return _SearchReader(self.options)


class LayerMetadata(DataSource):
    @classmethod
    def name(cls) -> str:
        return "layer_metadata"

    def schema(self) -> str:
        return "url string, body string"

    def reader(self, schema) -> DataSourceReader:
        return _MetadataReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CatalogSearch)
    spark.dataSource.register(LayerMetadata)


def hits(answers: DataFrame, limit: int | None = None) -> DataFrame:
    """Hits (query, pos and a hit's columns) of answers (query, body). Answers that aren't JSON objects with a results array, or none, give none; no more than the asked number."""
    parsed = answers.select("query", F.from_json("body", ANSWER).alias("r"))
    return parsed.select("query", F.posexplode("r.results").alias("pos", "h")).where(F.col("pos") < hits_asked(limit)).select("query", "pos", "h.*")


def metadata(bodies: DataFrame) -> DataFrame:
    """Parsed metadata of (url, body)."""
    return bodies.select("url", F.from_json("body", METADATA).alias("m")).select("url", "m.*")


def fetched(urls: DataFrame, **options: str) -> DataFrame:
    """(url, body) for a table of addresses too large to list: each executor asks for its own rows."""

    def ask(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({"url": pdf["url"], "body": [answer(options, u, u + ("&f=json" if "?" in u else "?f=json")) for u in pdf["url"]]})

    return urls.select("url").distinct().mapInPandas(ask, "url string, body string")
