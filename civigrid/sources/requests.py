"""Requests as tables: addresses in, one row with status, body and error for each out.

A transport takes a table of distinct addresses (``url``) and gives ``ANSWER``: ``recorded`` joins them with a table of
answers, ``live`` asks for them from the executors. No list of addresses passes through the driver, and a request that
fails in any way is a row that says why; it ends neither its task nor the run.
"""

from __future__ import annotations

import http.client
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANSWER = "url string, status int, body string, error string"
Transport = Callable[[DataFrame], DataFrame]


def settled(answers: DataFrame) -> DataFrame:
    """``ANSWER`` with the cause as error and no body where the request failed or its status isn't 200 to 299."""
    status = F.when(~F.col("status").between(200, 299), F.concat(F.lit("status "), F.col("status").cast("string")))
    missing = F.when(F.col("body").isNull(), F.lit("no body"))
    cause = F.coalesce(F.col("error"), status, missing)
    return answers.select("url", "status", F.when(cause.isNull(), F.col("body")).alias("body"), cause.alias("error"))


def recorded(answers: DataFrame) -> Transport:
    """Answers from a table (url, body, and status and error if it has them); of several for an address the one with the lowest status, then the first in order."""
    given = answers.select("url", *(F.col(c).alias(c) if c in answers.columns else F.lit(default).cast(kind).alias(c) for c, kind, default in (("status", "int", 200), ("body", "string", None), ("error", "string", None))))
    single = given.groupBy("url").agg(F.min(F.struct("status", "body", "error")).alias("a"))

    def answered(requests: DataFrame) -> DataFrame:
        both = requests.select("url").join(single, "url", "left")
        none = F.when(F.col("a").isNull(), F.lit("no recorded answer"))
        return settled(both.select("url", F.col("a.status").cast("int").alias("status"), F.col("a.body").alias("body"), F.coalesce(F.col("a.error"), none).alias("error")))

    return answered


def request(url: str, timeout: float) -> tuple[int | None, str | None, str | None]:
    """Status, body and error of one request. Bytes that aren't UTF-8 are replaced, as a browser does."""
    if not url.lower().startswith(("http://", "https://")):
        return None, None, "not an http address"
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": "application/json"}), timeout=timeout) as r:  # noqa: S310
            return r.status, r.read().decode("utf-8-sig", "replace"), None
    except urllib.error.HTTPError as e:
        return e.code, None, f"status {e.code} {e.reason}".rstrip()
    except (OSError, ValueError, http.client.HTTPException) as e:
        return None, None, f"{type(e).__name__}: {e}"


def live(per_host: int = 4, tasks: int = 200, timeout: float = 30, pause: float = 0) -> Transport:
    """Answers from the network. A host has ``per_host`` lanes, each the work of one task that asks for one address after another.

    So no host meets more requests at a time than it has lanes, and a host that most addresses are of is still dealt over
    all of its lanes. ``pause`` seconds lie between two requests of a task.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            urls, rows = b.column(0).to_pylist(), []
            for u in urls:
                rows.append(request(u, timeout))
                time.sleep(pause)
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(urls, pa.string()), *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.string()), strict=True))], names=["url", "status", "body", "error"])

    def answered(requests: DataFrame) -> DataFrame:
        host = F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/?#]*)", 1))
        lane = F.pmod(F.xxhash64("url"), F.lit(per_host))
        return settled(requests.select("url", host.alias("host"), lane.alias("lane")).repartition(tasks, "host", "lane").select("url").mapInArrow(ask, ANSWER))

    return answered


def search_address(query: Column, endpoint: str, most: int) -> Column:
    """The address of a catalogue search for a text: its first page, with at most so many hits."""
    return F.concat(F.lit(f"{endpoint}?q="), F.url_encode(query), F.lit(f"&num={most}&start=1&f=json"))


def json_object(body: Column) -> Column:
    """A body that is a JSON object, else null: only that is an answer."""
    return F.when(F.schema_of_variant(F.try_parse_json(body)).startswith("OBJECT"), body)
