"""Near-duplicate documents by SetSketch registers.

1. A map makes each text's set of distinct word shingles (64-bit hashes), a 128-bit digest of the set
   and the sketch: for each register the least of the set's hash values under the register's own
   permutation, taken as an exponential variable and stored on an exponentially spaced, truncated
   scale (base ``BASE``). Registers of a union are the maxima of registers, so sketches merge; two
   sets agree in a register with a chance close to their Jaccard similarity. Groups of ``ROWS``
   registers are hashed to band keys.
2. Texts with equal digests are one node: exact copies, however many, collapse before the next shuffle.
3. Nodes with a band key in common (a bucket) are candidates. First each is held against its buckets' least
   nodes only, which is linear in the entries of buckets: the similarity is estimated from both sketches and sizes by
   maximum likelihood, and unless that is far too low, confirmed on the full sets. The components of
   these links are what large groups of near copies collapse to.
4. Buckets whose nodes are of one component are done. In the others, nodes of different components are
   candidates. Sketches alone meet there first, and tell which nodes have a candidate whose estimate
   is not far too low; only these nodes' full sets meet next, where links are confirmed. A pair counts in the first bucket
   that it shares. Large buckets are dealt to blocks, of which every two meet in a task.
5. All confirmed links give the components. No node is compared with one that it shares no bucket with.

Chance that a pair at the threshold shares no band: (1 - 0.8 ** 6) ** 32, under 0.0001.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import components, kernel, shared

#: Registers in a band, and bands.
ROWS, BANDS = 6, 32
REGISTERS = ROWS * BANDS
#: Base of the registers' scale; at 1.1 every value fits a byte.
BASE = 1.1
#: Shingles (8 bytes each) that are sent to a task to be held against one set, or in a block of a bucket.
BLOCK = 1 << 18
#: Sketches in a block of a bucket.
SKETCHES = 1024
#: Standard deviations below the threshold at which an estimate rules a pair out.
DEVIATIONS = 4.5
#: Candidate nodes (about 90 bytes each) up to which the list of them is broadcast.
BROADCAST_NODES = 250_000
SALTS = 32

_rng = np.random.default_rng(20240229)
_FLIP = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint64).astype(np.uint32)
_ODD = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_BAND = kernel.mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingles of each text of the chunk, as 64-bit hashes."""
    data = kernel.lower_ascii(data)
    starts, ends, of = kernel.word_bounds(data, offs, kernel.NOT_SPACE)
    words = kernel.word_hashes(data, starts, ends)
    windows = kernel.window_hashes(words, k)
    out = []
    for a, b in zip(of[:-1].tolist(), of[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(windows[a : b - k + 1]))
        else:  # the whole sequence; its length keeps it apart from other lengths
            out.append(kernel.window_hashes(words[a:b], b - a) + np.uint64(b - a) if b > a else words[a:b])
    return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Registers of a set that is not empty."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        part = x[i : i + 2048, None] ^ _FLIP
        part *= _ODD
        np.minimum(least, part.min(axis=0), out=least)
    value = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32)
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)) + 40, 0, 255).astype(np.uint8)


def band_keys(registers: np.ndarray) -> np.ndarray:
    rows = registers.reshape(BANDS, ROWS).astype(np.uint64)
    packed = np.zeros(BANDS, np.uint64)
    for j in range(ROWS):
        packed = (packed << np.uint64(8)) | rows[:, j]
    with np.errstate(over="ignore"):
        return kernel.mix(packed * np.uint64(0x9E3779B97F4A7C15) + _BAND)


def digest(shingles: np.ndarray) -> bytes:
    """128 bits that identify a set."""
    with np.errstate(over="ignore"):
        a = kernel.mix(shingles).sum(dtype=np.uint64)
        b = kernel.mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return a.tobytes() + b.tobytes()


def _log_b(x: np.ndarray) -> np.ndarray:
    """p_b of the SetSketch paper: the chance that a register is greater."""
    return -np.log(np.maximum(1 - x * (BASE - 1) / BASE, 1e-12)) / np.log(BASE)


def estimate(own: np.ndarray, size: np.ndarray | int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Maximum likelihood estimates of the Jaccard similarity of sets (or one set) and others, from registers and sizes."""
    more = (own > others).sum(axis=1)
    less = (own < others).sum(axis=1)
    same = REGISTERS - more - less
    u, v = size / (size + sizes), sizes / (size + sizes)
    low, high = np.zeros(len(sizes)), np.minimum(u / v, v / u)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = np.maximum(_log_b(u - v * j), 1e-12), np.maximum(_log_b(v - u * j), 1e-12)
        return more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))

    for _ in range(30):  # the likelihood has one peak
        a, b = low + (high - low) / 3, high - (high - low) / 3
        up = likelihood(a) < likelihood(b)
        low, high = np.where(up, a, low), np.where(up, high, b)
    return (low + high) / 2


def _least(percent: int) -> float:
    """The estimate below which a pair is ruled out."""
    return percent / 100 - DEVIATIONS * np.sqrt(0.25 / REGISTERS)


def likely(x: int, rest: np.ndarray, registers: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Of ``rest``, those whose sizes and registers do not rule out that they are alike to x."""
    rest = rest[100 * np.minimum(sizes[rest], sizes[x]) >= percent * np.maximum(sizes[rest], sizes[x])]
    return rest[estimate(registers[x], sizes[x], registers[rest], sizes[rest]) >= _least(percent)] if len(rest) else rest


def first_shared(x: int, rest: np.ndarray, keys: np.ndarray, band: int) -> np.ndarray:
    """Of ``rest``, those whose first band key in common with x is that of the band."""
    return rest[(keys[rest] == keys[x]).argmax(axis=1) == band] if len(rest) else rest


class Forest:
    def __init__(self, roots: np.ndarray):
        self.root, self.size = roots.copy(), np.bincount(roots, minlength=len(roots))
        self.links: list[tuple[int, int]] = []

    def link(self, a: int, b: int) -> None:
        p, q = self.root[a], self.root[b]
        if p == q:
            return
        if self.size[p] < self.size[q]:
            p, q = q, p
        self.root[self.root == q] = p
        self.size[p] += self.size[q]
        self.links.append((a, b))


def alike(own: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """For which of some sets 100 * intersection >= percent * union with one set holds."""
    out = np.zeros(len(others), bool)
    for lo in range(0, len(others), 256):
        some = others[lo : lo + 256]
        sizes = np.array([len(s) for s in some])
        flat = np.concatenate(some)
        at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        both = np.add.reduceat((own[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
        out[lo : lo + 256] = 100 * both >= percent * (len(own) + sizes - both)
    return out


def confirm(sets: list[np.ndarray], percent: int, roots: np.ndarray | None = None, band: int | None = None) -> list[tuple[int, int]]:
    """Links, between what are components (``roots``) before, that span the components of all links.

    With the number of a band, only pairs whose first band key in common is that one's are tested.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    registers = np.stack([sketch(s) for s in sets])
    keys = np.stack([band_keys(r) for r in registers]) if band is not None else None
    forest = Forest(np.arange(n) if roots is None else roots)
    left = np.ones(n, bool)  # not yet compared with all nodes of other components

    def compare(x: int) -> None:
        left[x] = False
        rest = np.flatnonzero(forest.root != forest.root[x])
        if keys is not None:
            rest = first_shared(x, rest, keys, band)
        rest = likely(x, rest, registers, sizes, percent)
        if len(rest):
            for y in rest[alike(sets[x], [sets[y] for y in rest], percent)]:
                forest.link(x, int(y))

    # The node nearest to each register's commonest value is likely what the others are copies of.
    common = np.array([np.bincount(c, minlength=256).argmax() for c in registers.T])
    compare(int((registers == common).sum(axis=1).argmax()))
    # A pair needs no test if one of it was compared or both are in one component. So nodes that were not
    # compared may stay in one component only: that with most of them, as it is at the end.
    while left.any():
        at = forest.root[left]
        others = np.flatnonzero(left)[at != np.bincount(at).argmax()]
        if not len(others):
            break
        compare(int(others[0]))
    return forest.links


def _described(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, node (digest; null for an empty set), registers and copy (digest of the text) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, registers = [], [], []
            for _, _, data, offs in kernel.chunks(batch.column(1)):
                for s in shingle_sets(data, offs, k):
                    sizes.append(len(s))
                    nodes.append(digest(s) if len(s) else None)
                    registers.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(registers, pa.binary()), batch.column(2)],
                names=["doc_id", "n_shingles", "node", "registers", "copy"],
            )

    return kernel.map_arrow(docs.select("doc_id", "text", _copy().alias("copy")), run, f"doc_id {kind}, n_shingles bigint, node binary, registers binary, copy binary")


def _registers(column: pa.Array) -> np.ndarray:
    """A row of registers for each value."""
    data, _ = kernel.string_buffers(column)
    return data.reshape(-1, REGISTERS)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, registers) as (node, band)."""
    for batch in batches:
        keys = [band_keys(r) for r in _registers(batch.column(1))]
        rows = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
        flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(flat)], names=["node", "band"])


def _likely_pairs(percent: int):
    """Rows (a, b, n and registers of both) as those (a, b) that sizes and registers do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3))
            near = np.flatnonzero(100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            own, other = (_registers(batch.column(i))[near] for i in (4, 5))
            near = near[estimate(own, n[near], other, m[near]) >= _least(percent)] if len(near) else near
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(near)), batch.column(1).take(pa.array(near))], names=["a", "b"])

    return run


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows that are sorted by their first column, task, in lists of one task's; batches are made to rows a few at a time."""
    held: list[dict] = []
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            for row in batch.slice(lo, 64).to_pylist():
                if held and row["task"] != held[0]["task"]:
                    yield held
                    held = []
                held.append(row)
    if held:
        yield held


def _numbered(roots: list[bytes]) -> np.ndarray:
    """Equal values as equal small numbers."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(r, len(seen)) for r in roots])


def _pairs(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.binary()), pa.array([b for _, b in found], pa.binary())], names=["a", "b"])


def _held_against(percent: int):
    """Rows (task, first, node, shingles) as links of a task's nodes with the one that is its first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            own = next((np.frombuffer(r["shingles"], np.uint64) for r in rows if r["node"] == r["first"]), None)
            others = {r["node"]: np.frombuffer(r["shingles"], np.uint64) for r in rows if r["node"] != r["first"]}
            if own is not None and others:
                hit = alike(own, list(others.values()), percent)
                yield _pairs([(node, rows[0]["first"]) for node, is_alike in zip(others, hit, strict=True) if is_alike])
        yield _pairs([])

    return run


def _needed(percent: int):
    """Rows (task, band, node, root, n, registers) as (band, node) of nodes with a likely candidate of another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            registers = np.stack([np.frombuffer(r["registers"], np.uint8) for r in rows])
            keys = np.stack([band_keys(r) for r in registers])
            roots = _numbered([r["root"] for r in rows])
            sizes = np.array([r["n"] for r in rows])
            band = int(np.flatnonzero(keys[0] == np.uint64(rows[0]["band"] % (1 << 64)))[0])
            wanted = np.zeros(len(rows), bool)
            common = np.bincount(roots).argmax()
            for x in np.flatnonzero(roots != common):  # all pairs of different components have such a node
                near = likely(x, first_shared(x, np.flatnonzero(roots != roots[x]), keys, band), registers, sizes, percent)
                wanted[near] = True
                wanted[x] |= len(near) > 0
            some = [rows[i] for i in np.flatnonzero(wanted)]
            yield pa.RecordBatch.from_arrays([pa.array([r["band"] for r in some], pa.int64()), pa.array([r["node"] for r in some], pa.binary())], names=["band", "node"])

    return run


def _confirmed(percent: int):
    """Rows (task, band, node, root, shingles) as links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches):
            rows = list({r["node"]: r for r in rows}.values())
            sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
            keys = band_keys(sketch(sets[0]))
            band = int(np.flatnonzero(keys == np.uint64(rows[0]["band"] % (1 << 64)))[0])
            found = confirm(sets, percent, _numbered([r["root"] for r in rows]), band) if len(sets) > 1 else []
            yield _pairs([(rows[a]["node"], rows[b]["node"]) for a, b in found])
        yield _pairs([])

    return run


def _copy() -> Column:
    """128 bits that identify a text; null for null."""
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _sets(docs: DataFrame, wanted: DataFrame, k: int, columns: str) -> DataFrame:
    """Rows of ``wanted`` (node, doc_id, tasks: an array of structs of ``columns``), a row a task, with the node's full set as shingles."""
    few = wanted.count() <= BROADCAST_NODES
    texts = docs.select("doc_id", "text").join(F.broadcast(wanted) if few else wanted, "doc_id")
    names = [c.split(":")[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(1).to_pylist()
            for lo, _, data, offs in kernel.chunks(batch.column(0)):
                sets = shingle_sets(data, offs, k)
                own = [i for i, s in enumerate(sets) if len(s) and digest(s) == nodes[lo + i]]  # a text of the id may have another
                rows = pa.array([lo + i for i in own], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(rows) for c in (1, 2)), pa.array([sets[i].tobytes() for i in own], pa.binary())], names=["node", "tasks", "shingles"]
                )

    found = kernel.map_arrow(texts.select("text", "node", "tasks"), run, f"node binary, tasks array<struct<{columns}>>, shingles binary")
    found = found.select("node", "shingles", F.explode("tasks").alias("at"))
    return found.select(*[F.col(f"at.{c}").alias(c) for c in names], "node", "shingles").repartition("task").sortWithinPartitions("task")


def _blocks(rows: DataFrame, key: str, blocks: Column) -> DataFrame:
    """Rows, a row a task that they go to, as ``task``: with several blocks of a key, every two of them meet."""
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    one = F.lit(0).cast("bigint")
    others = F.when(F.col("blocks") == 1, F.array(one)).otherwise(F.filter(F.sequence(one, F.col("blocks") - F.lit(1).cast("bigint")), lambda j: j != mine))
    rows = rows.withColumn("blocks", blocks).withColumn("mine", mine).withColumn("other", F.explode(others))
    return rows.withColumn("task", F.xxhash64(key, F.least("mine", "other"), F.greatest("mine", "other"))).drop("blocks", "mine", "other")


def _links(docs: DataFrame, rows: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """Steps 3 and 4: links (a, b) that span the components."""
    sketches = nodes.select("node", "registers")
    banded = kernel.map_arrow(sketches, _banded, "node binary, band bigint").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    part = banded.groupBy("band", "salt").agg(F.min("node").alias("first"), F.count("*").alias("n"))
    heads = part.groupBy("band").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1").select("band", "first", "n")
    heads = shared.table(heads, "buckets")
    entries = shared.table(banded.select("node", "band").join(heads.select("band", "first"), "band"), "entries")

    # Each node with the least nodes of its buckets.
    pairs = entries.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    described = nodes.select("node", "n", "registers")
    pairs = pairs.join(described.toDF("a", "n_a", "r_a"), "a").join(described.toDF("b", "n_b", "r_b"), "b")
    pairs = shared.table(kernel.map_arrow(pairs.select("a", "b", "n_a", "n_b", "r_a", "r_b"), _likely_pairs(percent), "a binary, b binary"), "pairs")
    sized = nodes.select("node", "n")
    parts = pairs.join(sized.withColumnRenamed("node", "a"), "a").groupBy("b").agg(F.ceil(F.sum("n") / BLOCK).alias("parts"))
    parts = shared.table(parts, "parts")
    task = F.struct(F.xxhash64("first", "part").alias("task"), "first")
    ours = pairs.join(parts, "b").select(F.col("a").alias("node"), F.col("b").alias("first"), F.pmod(F.xxhash64("a"), F.col("parts")).alias("part"))
    theirs = parts.select(F.col("b").alias("node"), F.col("b").alias("first"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    # A node that very many others are held against goes to very many tasks: some at a time.
    tasks = ours.withColumn("some", F.lit(0).cast("bigint")).union(theirs.withColumn("some", F.floor(F.col("part") / 1000)))
    tasks = tasks.groupBy("node", "some").agg(F.collect_list(task).alias("tasks"))
    wanted = shared.table(tasks.join(nodes.select("node", "least"), "node").select("node", F.col("least").alias("doc_id"), "tasks"), "wanted")
    links = shared.table(kernel.map_arrow(_sets(docs, wanted, k, "task: bigint, first: binary"), _held_against(percent), "a binary, b binary"), "links")

    # Buckets with nodes of several components.
    roots = components.connect(links)
    entries = entries.select("node", "band").join(roots, "node", "left").select("node", "band", F.coalesce("root", "node").alias("root"))
    spread = entries.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS))).groupBy("band", "salt").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"))
    open_ = spread.groupBy("band").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).where("low <> high and n > 2").select("band", "n")
    some = shared.table(entries.join(open_, "band").join(described, "node").select("band", "node", "root", described["n"], "registers", open_["n"].alias("many")), "open")
    tasks = _blocks(some, "band", F.ceil(F.col("many") / SKETCHES)).select("task", "band", "node", "root", "n", "registers")
    needed = kernel.map_arrow(tasks.repartition("task").sortWithinPartitions("task"), _needed(percent), "band bigint, node binary").distinct()
    needed = shared.table(needed.join(some.select("band", "node", "root", "n"), ["band", "node"]), "needed")
    sizes = needed.groupBy("band").agg(F.ceil(F.sum("n") / BLOCK).alias("many"))
    tasks = _blocks(needed.join(sizes, "band"), "band", F.col("many")).groupBy("node").agg(F.collect_list(F.struct("task", "band", "root")).alias("tasks"))
    wanted = shared.table(tasks.join(nodes.select("node", "least"), "node").select("node", F.col("least").alias("doc_id"), "tasks"), "wanted")
    more = shared.table(kernel.map_arrow(_sets(docs, wanted, k, "task: bigint, band: bigint, root: binary"), _confirmed(percent), "a binary, b binary"), "links")
    return links.union(more)


def classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text).

    Words are split at white space after lower-casing A-Z; a text's set has its distinct k-word
    shingles, or the whole sequence if it has fewer words. Documents are linked if 100 * intersection
    >= percent * union; component_id is the smallest doc_id reachable by links, kept whether that is
    the document's own. Null and empty texts and texts without words have the empty set and are
    linked with nothing. A null doc_id names nothing: its row is kept, with a null component, and
    lends no id to others. Repeated rows each get a row; rows that share an id but not the text are
    linked by their own texts. An empty table gives an empty result; other columns are left out.
    """
    return _labelled(docs, k, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _labelled(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """What :func:`classes` gives, with copy (digest of the text) and root (the component's least node; null for an empty set)."""
    rows = shared.table(_described(docs, k), "sketches")
    known = rows.where("node is not null and doc_id is not null")
    nodes = shared.table(known.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")), "nodes")
    roots = components.connect(_links(docs, rows, nodes, k, percent))

    # Back to documents, by node; both sides are plain tables, so hot nodes are split when they are joined.
    named = nodes.join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "node", "least")
    ids = shared.table(named.groupBy("root").agg(F.min("least").alias("component_id")).join(named, "root").select("node", "component_id", "root"), "components")
    out = rows.select("doc_id", "n_shingles", "node", "copy").join(ids, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), "copy", "root")


def representatives(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each class of near duplicates of ``docs``, that of the smallest doc_id, with all its columns; see :func:`classes`.

    Texts with an empty set are alike to none and stay. Rows that share a doc_id are judged by their own
    texts: of a class's, that of the least digest stays; of rows that share the text too, and of rows with
    a null doc_id and one text, one.
    """
    labelled = _labelled(docs, k, percent).where("doc_id is not null")
    # Rows that share id and text; most corpora have none, and only such rows need to meet.
    repeated = shared.table(labelled.groupBy("doc_id", "copy").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("kept_id"), F.col("copy").alias("kept_copy")), "repeated")
    kept = labelled.where("kept").select("doc_id", "copy", "root")
    first = kept.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "copy")).alias("row")).select("row.*")
    kept = first.union(kept.where("root is null").select("doc_id", "copy")).distinct().toDF("kept_id", "kept_copy")
    same = (F.col("doc_id") == F.col("kept_id")) & _copy().eqNullSafe(F.col("kept_copy"))
    named = docs.where("doc_id is not null").join(kept, same, "left_semi")
    if not repeated.isEmpty():
        named = named.join(repeated, same, "left_anti").unionByName(named.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"]))
    nameless = docs.where("doc_id is null")
    return named.unionByName(nameless.dropDuplicates(["text"]))
