"""Near-duplicate vectors by a pivot-permutation index.

A bounded sample of the vectors gives the pivots (reference points). Every vector is described by its
``NEAREST`` nearest pivots in order, and stands in the inverted list of each of them. There, counting the
lists that two vectors share finds the candidates: those with ``SHARED`` pivots in common or more.
They are verified by cosine in double precision. A pair that meets in several lists counts in that of
its first common pivot only, so counts of links are exact sums over tasks.

A list is one task, or, with over ``BLOCK`` vectors, dealt to blocks of which every two meet in a task. One of over
``LONG`` is split first by a further pivot of each vector, as candidates have two in common: a vector then stands
in a list for each pair of its pivots, and a pair counts in that of its first two common ones, so nothing is lost.

Equal vectors are one node with a multiplicity, however many there are. With n vectors there are 2 root n
pivots up to 4,096, and 0.3 root n where that is more. Lists have about 5 root n vectors up to ten million vectors; beyond
that they are split, and lists of two pivots have about 90 n / pivots**2, so 1,000 at most whatever n is, but for vectors
that are truly close together. Comparisons so grow with n**1.5 first and with n in the end, and pivots, the
only thing that is broadcast, with its root. Vectors of each length have pivots, and so lists, of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import components, kernel, shared

#: Pivots that describe a vector, and how many two candidates have in common at least (two, for the lists of two pivots to be whole).
NEAREST, SHARED = 10, 2
#: Pivots: this many times the root of the count of vectors, up to a bound, and a lesser multiple beyond it.
PIVOTS_PER_ROOT, LEAST_PIVOTS, MANY_PIVOTS, FURTHER_PER_ROOT = 2.0, 32, 4096, 0.3
#: Memory of the pivots of one length of vectors, at most; lists grow again where it stops the pivots (at 64 numbers, beyond 10**12 vectors).
PIVOT_BYTES = 256 << 20
#: Vectors in a list, or in a block of one, that meet in a task; and vectors of a list beyond which it is split by a second pivot.
BLOCK = 1024
LONG = 16 * BLOCK
#: Long lists that are broadcast to the vectors' rows, at most; with more, they are joined.
BROADCAST_LISTS = 200_000


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def n_pivots(n: int, length: int) -> int:
    """How many pivots there are for n vectors of a length."""
    root = math.sqrt(n)
    wanted = max(min(PIVOTS_PER_ROOT * root, MANY_PIVOTS), FURTHER_PER_ROOT * root, LEAST_PIVOTS)
    return int(min(wanted, PIVOT_BYTES / (8 * length), max(n, 1)))


def fit(nodes: DataFrame, n: int, length: int) -> np.ndarray:
    """Pivots (unit rows): vectors in the order of a hash; the driver sorts a sample of about twice as many as are wanted, 1,000 at least."""
    p = n_pivots(n, length)
    few = nodes.where(shared.lowest(F.xxhash64("node", F.lit(17)), max(2 * p, 1000) / max(n, 1)))
    rows = few.orderBy(F.xxhash64("node", F.lit(18)), "node").limit(p).select("vector").toArrow()
    return _unit(_matrix(rows.column(0))) if rows.num_rows else np.zeros((0, 1))


def nearest(vectors: np.ndarray, pivots: np.ndarray, k: int = NEAREST) -> np.ndarray:
    """The k nearest pivots of each unit vector, nearest first; ties go to the lower number."""
    k = min(k, len(pivots))
    out = np.zeros((len(vectors), k), np.int32)
    for i in range(0, len(vectors), 2048):
        out[i : i + 2048] = np.argsort(-(vectors[i : i + 2048] @ pivots.T), axis=1, kind="stable")[:, :k]
    return out


def links(pivot: int, second: int, vectors: np.ndarray, near: np.ndarray, block: np.ndarray, crossing: bool, cosine: float, shared_least: int) -> np.ndarray:
    """Which pairs (upper triangle) of a list's unit vectors are links that count here.

    With a second pivot (not -1), the list is that of both. Where two blocks meet (``crossing``), only pairs of different blocks count.
    """
    n = len(vectors)
    count = np.zeros((n, n), np.int8)
    elsewhere = np.zeros((n, n), bool)
    flat, row = near.reshape(-1), np.repeat(np.arange(n), near.shape[1])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    bounds = np.flatnonzero(np.diff(flat, prepend=-1, append=-1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a > 1:
            at = np.ix_(row[a:b], row[a:b])
            count[at] += 1
            if flat[a] < pivot or pivot < flat[a] < second:
                elsewhere[at] = True
    wanted = np.triu((count >= shared_least) & ~elsewhere, 1)
    if crossing:
        wanted &= block[:, None] != block[None, :]
    if wanted.any():
        wanted &= vectors @ vectors.T >= cosine
    return wanted


def _forest(wanted: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that span the components of the links: each row's first link, and what joins components."""
    root = np.arange(len(wanted))
    out = []
    for x in range(len(wanted)):
        for y in np.flatnonzero(wanted[x] & (root != root[x])):
            if root[y] != root[x]:
                root[root == root[y]] = root[x]
                out.append((x, int(y)))
    return out


def _search(cosine: float, shared_least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def done() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks() if held else None
            if table is None or table.num_rows < 2:
                return
            node = table["node"].to_numpy()
            many = table["many"].to_numpy()
            wanted = links(table["pivot"][0].as_py(), table["second"][0].as_py(), _unit(_matrix(table["vector"])), _matrix(table["near"]).astype(np.int64), table["mine"].to_numpy(), table["crossing"][0].as_py(), cosine, shared_least)
            counts = wanted @ many + wanted.T @ many
            some = np.flatnonzero(counts)
            pairs = _forest(wanted)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([node[some], node[[a for a, _ in pairs]]])),
                    pa.array([None] * len(some) + [int(node[b]) for _, b in pairs], pa.int64()),
                    pa.array(np.concatenate([counts[some], np.zeros(len(pairs), np.int64)])),
                ],
                names=["a", "b", "n"],
            )

        for batch in batches:
            task = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1).tolist(), len(task)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                if task[lo] != key:
                    yield from done()
                    key, held = task[lo], []
                held.append(batch.slice(lo, hi - lo))
        yield from done()

    return run


def classes(vectors: DataFrame, cosine: float = 0.95, k: int = NEAREST) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding).

    Two rows are linked if the index retrieves them and their cosine, in double precision, is
    ``cosine`` or more; rows with equal vectors always are. n_links counts the other rows linked
    directly; component_id is the smallest vec_id reachable, kept whether that is the row's own.
    Vectors that are null, empty, zero or hold a null or a non-finite component are linked with
    nothing, and others with those of their length only. A null vec_id names nothing: its row is kept,
    with a null component, and is counted in no links. Repeated rows are rows with equal vectors. An
    empty table gives an empty result; other columns are left out.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0)
    good = F.coalesce(good & F.col("vec_id").isNotNull(), F.lit(False))
    # -0.0 and 0.0 are one number.
    rows = rows.withColumn("key", F.when(good, F.sha2(F.array_join(F.transform("vector", lambda x: (x + F.lit(0.0)).cast("string")), ","), 256)))
    nodes = rows.where("key is not null").groupBy("key").agg(F.min("vec_id").cast("bigint").alias("node"), F.count("*").alias("many"), F.first("vector").alias("vector"))
    nodes = shared.table(nodes, "vectors")
    # By length: the number of its first pivot, and its pivots.
    found, before = {}, 0
    for size, n in sorted(nodes.groupBy(F.size("vector")).count().collect()):
        found[size] = (before, fit(nodes.where(F.size("vector") == size), n, size))
        before += len(found[size][1])
    pivots = spark.sparkContext.broadcast(found)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for own in np.unique(length).tolist():
                first, points = pivots.value[own]
                some = batch.take(pa.array(np.flatnonzero(length == own)))
                near = first + nearest(_unit(_matrix(some.column(2))), points, k)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(near.reshape(-1).astype(np.int32)), near.shape[1]).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*some.columns, lists], names=["node", "many", "vector", "near"])

    described = kernel.map_arrow(nodes.select("node", "many", "vector"), describe, "node bigint, many bigint, vector array<double>, near array<int>")
    described = shared.table(described, "described")
    # A row for each pivot is broadcast: whether its list is long.
    lists = described.select(F.explode("near").alias("pivot")).groupBy("pivot").agg((F.count("*") > LONG).alias("long"))
    posted = described.withColumn("pivot", F.explode("near")).join(F.broadcast(lists), "pivot")
    second = F.when(F.col("long"), F.filter("near", lambda q: q > F.col("pivot"))).otherwise(F.array(F.lit(-1)))
    posted = posted.withColumn("second", F.explode(second))
    large = posted.groupBy("pivot", "second").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    sizes = shared.table(large.select("pivot", "second", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "long-lists")
    posted = posted.join(F.broadcast(sizes) if sizes.count() <= BROADCAST_LISTS else sizes, ["pivot", "second"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    posted = posted.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.xxhash64("pivot", "second", F.least("mine", "other"), F.greatest("mine", "other")).alias("task")
    posted = posted.select(task, "pivot", "second", "mine", (F.col("mine") != F.col("other")).alias("crossing"), "node", "many", F.col("vector").cast("array<float>").alias("vector") if _is_float(vectors) else "vector", "near")
    found = shared.table(kernel.map_arrow(posted.repartition("task").sortWithinPartitions("task"), _search(cosine, SHARED), "a bigint, b bigint, n bigint"), "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components.connect(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "linked")
    named = nodes.join(counts, "node", "left").join(roots, F.col("node") == F.col("linked"), "left")
    named = shared.table(named.select("key", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id")), "vector-classes")
    out = rows.select("vec_id", "key").join(named, "key", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", F.col("vec_id").cast("bigint")))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def _is_float(vectors: DataFrame) -> bool:
    return vectors.schema["embedding"].dataType.simpleString() == "array<float>"
