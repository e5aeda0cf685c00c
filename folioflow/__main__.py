"""Command line: python -m folioflow parse | index | export ... , also by spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators.history import build_index, update_index
from .plans.models import learned_embedder
from .sources.articles import parse_articles
from .sources.documents import article_files, load
from .sources.publishers import parse_publisher_files
from .sources.sinks import parsed_articles


def main(argv: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="folioflow", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    parse = sub.add_parser("parse", help="publisher files to article elements")
    parse.add_argument("--input", required=True, help="a folder of .html and .xml files, or a JSON list of files")
    parse.add_argument("--output", required=True)
    parse.add_argument("--skip", help="a text file of DOIs to leave out")
    parse.add_argument("--limit", type=int)
    index = sub.add_parser("index", help="canonical articles to a store that is kept up to date")
    index.add_argument("--input", required=True)
    index.add_argument("--store", required=True)
    index.add_argument("--record", required=True)
    index.add_argument("--namespace", default="default")
    index.add_argument("--cleanup", choices=("incremental", "full", "none"), default="incremental")
    index.add_argument("--force", action="store_true")
    plain = sub.add_parser("plain", help="canonical articles to a plain or a vector store")
    plain.add_argument("--input", required=True)
    plain.add_argument("--store", required=True)
    plain.add_argument("--full-text", action="store_true")
    plain.add_argument("--vectors", action="store_true")
    args = top.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    raw = article_files(spark, args.input)
    if args.command == "parse":
        skip = spark.read.text(args.skip).select(F.trim("value").alias("doi")) if args.skip else None
        rows, failed = parsed_articles(raw, parse_publisher_files, skip, args.limit)
        rows.write.mode("overwrite").parquet(f"{args.output}/articles")
        failed.write.mode("overwrite").parquet(f"{args.output}/failed")
    elif args.command == "index":
        docs = parse_articles(raw).where("error IS NULL").drop("error")
        print(update_index(spark, docs, args.store, args.record, args.namespace, F.current_timestamp(), None if args.cleanup == "none" else args.cleanup, args.force))
    else:
        embed = learned_embedder(load(raw, args.full_text).where("error IS NULL")) if args.vectors else None
        build_index(spark, raw, lambda df: load(df, args.full_text), args.store, embed)


if __name__ == "__main__":
    main()
