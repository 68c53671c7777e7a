"""Commands: places, discover, build, validate."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

USAGE = "commands: places ARCHIVE OUT | discover PLACES OUT [--recorded ANSWERS] [--folder FOLDER] [--again] | discover PLACES HITS METADATA OUT | build PLACES SOURCES OUT | validate REGISTRY"


class Parser(argparse.ArgumentParser):
    def error(self, message: str):
        raise ValueError(message)


def parse(argv: list[str]) -> argparse.Namespace:
    """A missing value and an unknown flag are errors; the state is put in capitals; ``review`` has no effect."""
    p = Parser(prog="civigrid", usage=USAGE, allow_abbrev=False)
    p.add_argument("command")
    p.add_argument("paths", nargs="*")
    p.add_argument("--city", default="")
    p.add_argument("--state", default="", type=str.upper)
    p.add_argument("--placeFips", default="")
    p.add_argument("--recorded", default="", help="a table of answers as JSON lines (url, status, body) instead of the network")
    p.add_argument("--folder", default="", help="where answers are kept, so that a run that broke off goes on")
    p.add_argument("--again", action="store_true", help="ask once more for what failed in earlier runs")
    p.add_argument("--endpoint", default="")
    p.add_argument("--review", action="store_true")
    p.add_argument("--verbose", action="store_true")
    return p.parse_args(argv)


def report(spark: SparkSession, tables: dict[str, DataFrame], verbose: bool) -> list[str]:
    """Totals, the places without a source, the failed ones; and each place's five best layers."""
    from civigrid.functions.text import fixed
    from civigrid.operators.selection import top
    from civigrid.plans.discovery import summary

    lines = [f"{k}: {v}" for k, v in summary(tables["results"]).first().asDict().items()]
    results = tables["results"]
    lines += [f"no source: {r.city}, {r.state}" for r in results.where("error IS NULL AND n_chosen = 0").orderBy("place_fips").toLocalIterator()]
    lines += [f"failed: {r.city}, {r.state}: {r.error}" for r in results.where("error IS NOT NULL").orderBy("place_fips").toLocalIterator()]
    if verbose:
        best = top(tables["inspected"]).where(F.col("score") > float("-inf")).select("place_fips", "place_rank", "url", fixed(F.col("score"), 3).alias("score"), F.array_join("reasons", "; ").alias("why"))
        lines += [f"not inspected: {r.place_fips} {r.url}: {r.cause}" for r in tables["uninspected"].orderBy("place_fips", "ord").toLocalIterator()]
        lines += [f"{r.place_fips} {r.place_rank}. {r.url} {r.score} ({r.why})" for r in best.orderBy("place_fips", "place_rank").toLocalIterator()]
    return lines


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    from civigrid.operators.places import chosen as choose
    from civigrid.operators.registry import built
    from civigrid.operators.validation import generated_entries, require_valid
    from civigrid.plans import crawl
    from civigrid.plans.discovery import discovered
    from civigrid.sources import documents, gazetteer, recorded, requests

    if args.command == "places" and len(args.paths) == 2:
        n = gazetteer.generate_places(spark, *args.paths).count()
        print(f"{n} places")
    elif args.command == "discover" and len(args.paths) in (2, 4):
        rows = gazetteer.read_places(spark, args.paths[0]).withColumnRenamed("placeFips", "place_fips")
        rows = choose(rows, args.city, args.state, args.placeFips).select("place_fips", "city", "state")
        if len(args.paths) == 2:
            answers = requests.recorded(spark.read.schema("url string, status int, body string").json(args.recorded)) if args.recorded else requests.live()
            tables = crawl.crawled(rows, answers, args.folder or None, endpoint=args.endpoint or crawl.ENDPOINT, again=args.again)
        else:
            tables = discovered(rows, recorded.hits(spark.read.schema("query string, body string").json(args.paths[1])), spark.read.schema("url string, body string").json(args.paths[2]))
        print("\n".join(report(spark, tables, args.verbose)))
        documents.write_registry(built(rows, tables["chosen"], spark.sql("SELECT date_format(now(), \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")").first()[0]), args.paths[-1])
    elif args.command == "build" and len(args.paths) == 3:
        rows = gazetteer.read_places(spark, args.paths[0]).select(F.col("placeFips").alias("place_fips"), "city", "state")
        documents.write_registry(built(rows, spark.read.parquet(args.paths[1]), spark.sql("SELECT date_format(now(), \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")").first()[0]), args.paths[2])
    elif args.command == "validate" and len(args.paths) == 1:
        checked = generated_entries(documents.read_generated(spark, args.paths[0]))
        for r in checked.where("error IS NOT NULL").orderBy("pos").toLocalIterator():
            print(r.error)
        print(json.dumps({"valid": require_valid(checked).count()}))
    else:
        print(USAGE)
        return 1
    return 0


def main(argv: list[str] | None = None) -> int:
    try:
        args = parse(sys.argv[1:] if argv is None else argv)
        return run(SparkSession.builder.appName("civigrid").getOrCreate(), args)
    except Exception as e:
        print(e, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
