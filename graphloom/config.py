"""Graphs from a declarative configuration, as a dict or a JSON file.

{"type": "tables", "path": folder, "mapping": {...}} is a virtual graph over Parquet tables;
{"type": "triples", "path": file or folder, "format": ...} holds triples, from a file or none.
Both take "rules" (text) or "rules_file", and "prefixes".
"""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

from .graph import Graph, TableGraph, TripleGraph
from .sources.mapping import read_tables


class ConfigProblem(ValueError):
    """The configuration lacks something or names something unknown."""


def open_graph(spark: SparkSession, config: dict[str, Any] | str) -> Graph:
    """The graph that a configuration (or the JSON file of that name) describes."""
    if isinstance(config, str):
        config = json.loads(Path(config).read_text())
    unknown = set(config) - {"type", "path", "format", "mapping", "rules", "rules_file", "prefixes", "rewrites"}
    if unknown:
        raise ConfigProblem(f"unknown settings: {', '.join(sorted(unknown))}")
    rules = config.get("rules", "") or (Path(config["rules_file"]).read_text() if "rules_file" in config else "")
    options: dict[str, Any] = {"rules": rules, "prefixes": config.get("prefixes")}
    kind = config.get("type", "triples")
    if kind == "tables":
        if "mapping" not in config or "path" not in config:
            raise ConfigProblem("a graph over tables needs a mapping and a path")
        graph: Graph = TableGraph(spark, config["mapping"], read_tables(spark, config["path"], list(config["mapping"]["tables"])), **options)
    elif kind == "triples":
        graph = TripleGraph.load(spark, config["path"], config.get("format"), **options) if config.get("path") else TripleGraph(spark, **options)
    else:
        raise ConfigProblem(f"unknown type {kind!r}")
    graph.rewrites = config.get("rewrites", True)
    return graph


class Builder:
    """The same, step by step: ``Builder(spark).tables(mapping, path).rules(text).build()``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.config = spark, {}

    def tables(self, mapping: dict, path: str) -> Builder:
        self.config |= {"type": "tables", "mapping": mapping, "path": path}
        return self

    def triples(self, path: str | None = None, form: str | None = None) -> Builder:
        self.config |= {"type": "triples", "path": path, "format": form}
        return self

    def rules(self, text: str) -> Builder:
        self.config["rules"] = text
        return self

    def prefixes(self, **prefixes: str) -> Builder:
        self.config["prefixes"] = prefixes
        return self

    def build(self) -> Graph:
        return open_graph(self.spark, self.config)
