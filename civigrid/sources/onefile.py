"""One JSON document out of many tasks, and what the file system says of a path."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def located_path(spark: SparkSession, path: str) -> tuple:
    """A path and its file system, as the JVM has them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def stamp(spark: SparkSession, path: str) -> tuple:
    """Names, lengths and times of change of a file, or of the files in a folder; it differs once one of them was written anew."""
    fs, at = located_path(spark, path)
    return tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(at)))


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    return [p for p in paths if (found := located_path(spark, p))[0].exists(found[1])]


def write_document(rows: DataFrame, entry: Column, head: str, foot: str, path: str) -> None:
    """Writes ``head``, the JSON objects ``entry`` of all rows with commas between them, and ``foot`` as one file.

    ``rows`` are sorted; each task writes its range of them as a part beside ``path``. The file system copies the parts, one
    after the other, into a file that takes the place of what was at ``path`` in one step. No task holds all rows, and a
    run that breaks off leaves ``path`` as it was.
    """
    spark = rows.sparkSession
    folder = f"{path}.parts-{uuid.uuid4().hex}"
    fs, parts = located_path(spark, folder)
    jvm = spark._jvm.org.apache.hadoop
    try:
        rows.select(F.concat(F.lit(","), F.to_json(entry, {"pretty": "true"}))).write.text(folder)
        whole, target = jvm.fs.Path(f"{folder}/whole.json"), jvm.fs.Path(path)
        out = fs.create(whole)
        try:
            out.write(bytearray(head.encode()))
            skip = 1  # the comma before the first row
            for status in sorted((s for s in fs.listStatus(parts) if s.getPath().getName().startswith("part-") and s.getLen()), key=lambda s: s.getPath().getName()):
                part = fs.open(status.getPath())
                try:
                    part.seek(skip)
                    jvm.io.IOUtils.copyBytes(part, out, 1 << 16, False)
                finally:
                    part.close()
                skip = 0
            out.write(bytearray(foot.encode()))
        finally:
            out.close()
        if fs.exists(target) and fs.getFileStatus(target).isDirectory():
            fs.delete(target, True)
        over = spark._sc._gateway.new_array(jvm.fs.Options.Rename, 1)
        over[0] = jvm.fs.Options.Rename.OVERWRITE
        jvm.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(whole), fs.makeQualified(target), over)
    finally:
        fs.delete(parts, True)
