"""Discovery from places and a transport alone: requests in waves.

The addresses of a wave follow from the answers to the one before: searches give candidates, candidates give services
and layers, services give their best layers. Each wave's distinct addresses are anti-joined with those that are answered,
and answers are appended to a table, batch by batch, so a run that broke off goes on where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civigrid.functions import urls
from civigrid.operators.fields import METADATA, best_layers, service_layers
from civigrid.operators.staging import new_path, staged
from civigrid.plans.discovery import candidates, discovered, distinct_urls, search_texts
from civigrid.sources.recorded import hits_asked
from civigrid.sources.requests import ANSWER, Transport, json_object, search_address

#: Fixed value: where the catalogue is searched unless told otherwise.
ENDPOINT = "https://www.arcgis.com/sharing/rest/search"
#: Requests whose answers are written together; what a run loses at most when it breaks off.
BATCH = 100_000
# What a value of the wrong type leads to, where an address or a text is looked at.
NO_ADDRESS, NO_TEXT = "url.trim is not a function", "(value ?? \"\").toLowerCase is not a function"


class Frontier:
    """Which addresses have been asked for, and the answers: a table in ``folder``, which any later run goes on with.

    A failed request is an answer too; ``again`` asks once more for those that failed in earlier runs.
    """

    def __init__(self, spark: SparkSession, folder: str, transport: Transport, batch: int = BATCH, again: bool = False):
        self.spark, self.path, self.transport, self.batch = spark, f"{folder}/answers", transport, batch
        spark.createDataFrame([], ANSWER).write.mode("append").parquet(self.path)  # so that there is a table
        self.old = staged(self.table().where("error IS NOT NULL").select("url").distinct()) if again else None

    def table(self) -> DataFrame:
        return self.spark.read.schema(ANSWER).parquet(self.path)

    def answers(self) -> DataFrame:
        """One answer for each address: a good one if there is any."""
        return self.table().groupBy("url").agg(F.min(F.struct(F.col("error").isNotNull().alias("failed"), "status", "body", "error")).alias("a")).select("url", "a.status", "a.body", "a.error")

    def ask(self, wanted: DataFrame) -> int:
        """Asks for the addresses (``url``) that have no answer yet; gives their number."""
        done = self.table().select("url")
        if self.old is not None:
            done = done.join(self.old, "url", "left_anti")
            self.old = self.old.join(wanted.select("url"), "url", "left_anti")
        new = staged(wanted.select("url").where("url IS NOT NULL").distinct().join(done, "url", "left_anti"))
        n = new.count()
        parts = -(-n // self.batch)
        for k in range(parts):
            some = new.where(F.pmod(F.xxhash64("url"), F.lit(parts)) == k)
            self.transport(some).write.mode("append").parquet(self.path)
        return n


def search_hits(answers: DataFrame, most: int) -> DataFrame:
    """Hits (query, pos, title, url, url_error) of search answers (query, body).

    An answer that is no object, or whose results are no list, has none; a list ends where an item is null. A hit's
    address is null unless it is a text; a value of another type (but 0 and false) is an error of the place that
    asked, which shows once the address is looked at.
    """
    v = F.try_variant_get(F.try_parse_json(json_object(F.col("body"))), "$.results", "array<variant>")
    ends = F.array_position(F.transform("v", lambda x: F.coalesce(F.schema_of_variant(x), F.lit("VOID"))), "VOID")
    whole = answers.select("query", v.alias("v")).withColumn("v", F.when(ends > 0, F.slice("v", F.lit(1), (ends - 1).cast("int"))).otherwise(F.col("v")))
    rows = whole.select("query", F.posexplode("v").alias("pos", "v")).where(F.col("pos") < most)
    kind, text, title = F.schema_of_variant(F.try_variant_get("v", "$.url", "variant")), *(F.try_variant_get("v", f"$.{name}", "string") for name in ("url", "title"))
    odd = kind.isNotNull() & ~kind.isin("STRING", "VOID") & ~F.coalesce(text, F.lit("?")).isin("0", "false")
    return rows.select("query", "pos", title.alias("title"), F.when(kind == "STRING", text).alias("url"), F.when(odd, F.lit(NO_ADDRESS)).alias("url_error"))


def text_faults(metadata: DataFrame) -> DataFrame:
    """Addresses (``url``) of ``metadata`` (url, body) whose name or description is no text: what has them can't be classified."""
    v = F.try_parse_json("body")

    def odd(path: str):
        return ~F.coalesce(F.schema_of_variant(F.try_variant_get(v, path, "variant")), F.lit("VOID")).isin("STRING", "VOID")

    return metadata.where(odd("$.name") | odd("$.description")).select(urls.request_key(F.col("url")).alias("url"), F.lit(NO_TEXT).alias("cause")).distinct()


def best_addresses(metadata: DataFrame) -> DataFrame:
    """The best layer's address (``key``) of each service in ``metadata`` (url, body) that names layers."""
    m = F.from_json("body", METADATA)
    services = metadata.where(~urls.is_layer(F.col("url"))).select("url", m.alias("m")).where(F.col("m").isNotNull() & F.col("m.error").isNull())
    listed = services.select("url", F.posexplode(service_layers(F.coalesce("m.layers", F.array().cast("array<struct<id:int,name:string,url:string>>")), F.col("url"))).alias("pos", "l"))
    return best_layers(listed.select("url", "pos", "l.name", F.col("l.url").alias("best")), ["url"]).select(urls.request_key(F.col("best")).alias("key"))


def gathered(places: DataFrame, transport: Transport, folder: str | None = None, endpoint: str = ENDPOINT, limit: int | None = None, batch: int = BATCH, again: bool = False) -> dict[str, DataFrame]:
    """What a run over ``places`` (place_fips, city, state) learns by asking: hits, metadata, failures of places, and all requests with their answers.

    With ``folder`` the answers stay, and a run that broke off goes on with them; without it they are in the shared folder
    until the driver's process ends.
    """
    spark = places.sparkSession
    frontier = Frontier(spark, folder or new_path(spark, "crawl"), transport, batch, again)
    most = hits_asked(limit)
    searches = search_texts(places)
    asked = searches.select("query").distinct().withColumn("url", search_address(F.col("query"), endpoint, most))
    frontier.ask(asked)
    hits = staged(search_hits(asked.join(frontier.answers(), "url").select("query", "body"), most))
    broken = searches.join(hits.where("url_error IS NOT NULL").select("query", "pos", "url_error"), "query")
    failures = broken.groupBy("place_fips").agg(F.min_by("url_error", F.struct("query_no", "pos")).alias("error"))
    keys = distinct_urls(candidates(searches, hits)).select(urls.request_key(F.col("url")).alias("key")).distinct()
    known = staged(keys.where(urls.service_type(F.col("key")) != "unknown").withColumn("url", urls.metadata_url(F.col("key"))))
    frontier.ask(known)

    def bodies(wanted: DataFrame) -> DataFrame:
        return wanted.join(frontier.answers(), "url").select(F.col("key").alias("url"), json_object(F.col("body")).alias("body"))

    second = staged(best_addresses(bodies(known)).distinct().withColumn("url", urls.metadata_url(F.col("key"))))
    frontier.ask(second)
    return {"hits": hits, "failures": failures, "metadata": bodies(known.union(second).distinct()), "requests": frontier.answers()}


def crawled(places: DataFrame, transport: Transport, folder: str | None = None, **options) -> dict[str, DataFrame]:
    """A discovery run: the tables of ``discovered`` and all ``requests``; for the options see ``gathered``.

    A search or an address that fails leaves its hits or its layer out. A place fails, with the cause, if an address among
    its hits is no text; other places don't notice. A candidate whose metadata can't be read as text is left uninspected.
    """
    found = gathered(places, transport, folder, **options)
    metadata = staged(found["metadata"])
    return discovered(places, found["hits"], metadata, found["failures"], text_faults(metadata)) | {"requests": found["requests"]}
