"""Runs a query or update file: ``python -m graphloom --config graph.json query.rq``."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from .config import open_graph
from .graph import TripleGraph


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="graphloom", description="Queries a graph that a JSON file describes.")
    parser.add_argument("--config", required=True, help="JSON file: see graphloom.config")
    parser.add_argument("--update", action="store_true", help="run updates, and print the graph as N-Triples to --out")
    parser.add_argument("--native", action="store_true", help="run a native graph query")
    parser.add_argument("--explain", action="store_true", help="print the plan instead of running")
    parser.add_argument("--out", help="folder for the result: Parquet, or N-Triples after updates; else rows are shown")
    parser.add_argument("file", help="the text to run, or - for standard input")
    given = parser.parse_args(arguments)
    text = sys.stdin.read() if given.file == "-" else Path(given.file).read_text()
    graph = open_graph(SparkSession.builder.appName("graphloom").getOrCreate(), given.config)
    if given.explain:
        print(graph.explain(text))
    elif given.update:
        if not isinstance(graph, TripleGraph):
            parser.error("only stored triples can be updated")
        graph.update(text)
        if given.out:
            graph.dump(given.out)
    else:
        found = graph.native(text) if given.native else graph.query(text)
        if given.out:
            found.write.parquet(given.out)
        else:
            found.show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
