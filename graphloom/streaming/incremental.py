"""Triples from a stream, with rules kept up to date.

Lines of N-Triples are parsed as a stream; each micro-batch extends the graph, and forward rules run
semi-naively from its new triples alone. A batch that is delivered again changes nothing, since the
graph is a set.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..graph import TripleGraph
from ..sources.readers import parse_lines


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Triples (g, s, p, o) of the N-Triples files that arrive in a folder, as a stream."""
    return parse_lines(spark.readStream.text(folder))


def follow(graph: TripleGraph, triples: DataFrame, checkpoint: str, after: Callable[[TripleGraph, int], None] | None = None, once: bool = False) -> StreamingQuery:
    """Extends the graph by a stream of triples; ``after`` is called with the graph and the batch's number.

    With ``once``, what is there already is read and the query ends.
    """

    def take(batch: DataFrame, number: int) -> None:
        graph.extend(batch)
        if after is not None:
            after(graph, number)

    writer = triples.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
