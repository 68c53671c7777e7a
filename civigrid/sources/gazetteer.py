"""Gazetteer files and place documents: reading and writing."""

from __future__ import annotations

import io
import json
import urllib.request
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civigrid.functions.text import iso_now
from civigrid.operators.places import places, sorted_places
from civigrid.sources.onefile import write_document

PLACES = "source string, year int, generatedAt string, places array<struct<placeFips:string,city:string,state:string,stateFips:string,placeName:string,placeType:string,geoidFq:string,ansicode:string,funcstat:string,latitude:double,longitude:double>>"
NAMES = {"place_fips": "placeFips", "city": "city", "state": "state", "place_name": "placeName", "place_type": "placeType", "geoid_fq": "geoidFq", "ansicode": "ansicode", "funcstat": "funcstat", "latitude": "latitude", "longitude": "longitude"}


def download(url: str) -> bytes:
    """A gazetteer archive; a status other than success is an error that names it and the address."""
    try:
        with urllib.request.urlopen(url) as r:  # noqa: S310
            return r.read()
    except urllib.error.HTTPError as e:
        raise RuntimeError(f"download failed with status {e.code}: {url}") from e


def member_text(archive: bytes) -> str:
    """The first ``.txt`` member of an archive; an error lists the members if there is none."""
    with zipfile.ZipFile(io.BytesIO(archive)) as z:
        names = z.namelist()
        if not names:
            raise ValueError("the gazetteer archive is empty")
        text = next((n for n in names if n.lower().endswith(".txt")), None)
        if text is None:
            raise ValueError(f"the gazetteer archive has no text file; it has {', '.join(names)}")
        return z.read(text).decode("utf-8")


def read_zip(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the archives' text members: (path, pos, line). Archives are unpacked by the executors."""

    def unpack(batches):
        import pandas as pd

        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                lines = member_text(bytes(content)).split("\n")
                for at in range(0, len(lines), 50_000):
                    part = lines[at : at + 50_000]
                    yield pd.DataFrame({"path": p, "pos": range(at, at + len(part)), "line": part})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(unpack, "path string, pos long, line string")


def parse_lines(lines: DataFrame) -> DataFrame:
    """Rows of gazetteer lines (pos, line), all columns as text, with ``ord``; fewer than two lines are an error."""
    full = lines.withColumn("line", F.regexp_replace("line", "\r$", "")).where(F.trim("line") != "")
    head = full.orderBy("pos").limit(2).collect()
    if len(head) < 2:
        raise ValueError("the gazetteer has no rows")
    names = head[0].line.split("|")
    parts = F.split("line", r"\|", -1)
    return full.where(F.col("pos") > head[0].pos).select(F.col("pos").alias("ord"), *(F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a pipe-delimited gazetteer file, all columns as text."""
    return spark.read.csv(path, sep="|", header=True, inferSchema=False, quote="", escape="")


def read_places(spark: SparkSession, path: str, validate: bool = False) -> DataFrame:
    """Places of a places document in file order (``ord``); a document without places is an error.

    ``validate`` also checks the rows and drops what the validated form doesn't have.
    """
    doc = spark.read.schema(PLACES).json(path, multiLine=True)
    top = doc.select(F.col("places").isNull().alias("none"), *([F.col("source").isNull().alias("s"), F.col("year").isNull().alias("y"), F.col("generatedAt").isNull().alias("g")] if validate else [])).first()
    if top is None or top.none:
        raise ValueError("Invalid Census place dataset: missing places array.")
    if validate:
        for bad, what in ((top.s, "source"), (top.y, "year"), (top.g, "generatedAt")):
            if bad:
                raise ValueError(f"Invalid Census place dataset: missing {what}.")
    rows = doc.select(F.posexplode("places").alias("ord", "p")).select("ord", "p.*")
    if not validate:
        return rows
    from civigrid.operators.validation import place_rows

    checked = place_rows(rows)
    bad = checked.where("error IS NOT NULL").select("error").limit(1).collect()
    if bad:
        raise ValueError(bad[0].error)
    return checked.drop("error").cache()


def write_places(found: DataFrame, path: str, source: str, year: int) -> None:
    """A places document: one file, which replaces what was there at once; no place at all is an error."""
    if not found.take(1):
        raise ValueError("the gazetteer gave no incorporated places")
    now = found.sparkSession.range(1).select(iso_now()).first()[0]
    head = f'{{"source":{json.dumps(source)},"year":{year},"generatedAt":{json.dumps(now)},"places":['
    write_document(sorted_places(found).select(*(F.col(c).alias(n) for c, n in NAMES.items())), F.struct(*NAMES.values()), head, "]}\n", path)


def generate_places(spark: SparkSession, archive: str, out: str, source: str = "gazetteer", year: int = 2025) -> DataFrame:
    """Archive to places document."""
    found = places(parse_lines(read_zip(spark, archive)))
    write_places(found, out, source, year)
    return found
