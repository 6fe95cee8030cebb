"""Commands: `python -m claimloom.cli merge|validate|ris ...`."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import merge, validate
from .plans import stages
from .sources import graphs, ris


def _graphs(spark: SparkSession, folder: str):
    read = graphs.read_graphs(graphs.list_graphs(spark, folder))
    return graphs.child(read, "nodes"), graphs.child(read, "edges")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="claimloom")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, words in (("merge", "merge the graph files of a folder into a versioned table"), ("validate", "list integrity problems of graph files"), ("ris", "turn bibliographic exports into a manifest")):
        command = commands.add_parser(name, help=words)
        command.add_argument("folder")
        if name != "validate":
            command.add_argument("--out", required=True)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("claimloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "ris":
        ris.manifest(ris.read_ris(spark, args.folder), ["depth", "file", "record_no"]).write.mode("overwrite").parquet(args.out)
        return 0
    nodes, edges = _graphs(spark, args.folder)
    if args.command == "validate":
        problems = validate.check_integrity(nodes, edges)
        problems.show(50, truncate=False)
        return int(not problems.isEmpty())
    found = merge.consolidate(nodes.withColumn("node", F.col("id")), edges.withColumnRenamed("id", "edge"), stages.NODE_FACETS, stages.NODE_FIELDS, stages.EDGE_FIELDS)
    print(stages.write_back(spark, args.out, found["nodes"], found["edges"]))
    return 0


if __name__ == "__main__":
    sys.exit(main())
