"""Benchmark decontamination: Wu-Manber multi-pattern search for word windows.

A benchmark text's windows (runs of ``n`` words; a shorter text is one window) are the patterns.
Patterns of one length form a searcher with three tables:

* SHIFT, by the hash of a block of words: how far the search may move on after it has seen the block
  at the window's end, because no pattern has the block nearer to its end;
* buckets, by the block that ends a pattern, of the patterns that end so;
* the patterns' own words, for the direct comparison that confirms an occurrence.

The search moves many lanes (stretches of documents) at once, so each step is a few numpy calls.
Words are compared as 64-bit fingerprints of their bytes, all words of the window.

The documents are not shuffled: each text is searched where it is read. Only the benchmark's
tables are sent to the executors, in blocks of at most ``BLOCK_BYTES`` of benchmark text: the
documents pass one searcher after another and carry the words hit so far along as a bit map.

That is so for a benchmark of up to ``BENCHMARK_BYTES``, which is checked first. The patterns of a larger one
stay a table, which the documents' windows are joined with by hash; the direct comparison is the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, shared

#: Benchmark text in one set of tables; its tables take about 40 times as much memory at most.
BLOCK_BYTES = 4 << 20
#: Benchmark text that is sent to executors, at most, as every block of it is held by a Python worker of each core.
BENCHMARK_BYTES = 8 << 20
#: Positions that one lane covers.
LANE = 2048
_BITS = 20


class Searcher:
    """All patterns of ``m`` words. patterns: distinct rows of m word hashes."""

    def __init__(self, patterns: np.ndarray):
        self.patterns, self.m = patterns, patterns.shape[1]
        self.block = min(2, self.m)
        self.shift = np.full(1 << _BITS, self.m - self.block + 1, np.int16)
        for end in range(self.block, self.m + 1):
            at = self._block_hash(patterns[:, end - 1], patterns[:, end - self.block])
            np.minimum.at(self.shift, at >> np.uint64(64 - _BITS), np.int16(self.m - end))
        suffix = self._block_hash(patterns[:, -1], patterns[:, -self.block])
        order = np.argsort(suffix, kind="stable")
        self.by_suffix, (self.suffixes, self.begins) = order, np.unique(suffix[order], return_index=True)
        self.begins = np.append(self.begins, len(order))

    def _block_hash(self, last: np.ndarray, first: np.ndarray) -> np.ndarray:
        return kernel.mix(last) if self.block == 1 else kernel.mix(last * np.uint64(0x2545F4914F6CDD1D) + first)

    def find(self, words: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last word's position, pattern) of each occurrence; text i is ``words[of[i]:of[i + 1]]``."""
        ends = self._candidates(words, of)
        suffix = self._block_hash(words[ends], words[ends - (self.block - 1)])
        bucket = np.searchsorted(self.suffixes, suffix)
        bucket[bucket == len(self.suffixes)] = 0
        known = self.suffixes[bucket] == suffix
        ends, bucket = ends[known], bucket[known]
        # A bucket's patterns are in the order of their words, so a binary search leaves one to compare with, however full it is.
        # A position has one pattern at most, since patterns are distinct and of one length.
        at, stop = self.begins[bucket], self.begins[bucket + 1]
        high = stop.copy()
        while (open_ := np.flatnonzero(at < high)).size:
            middle = (at[open_] + high[open_]) // 2
            less = self._less(self.by_suffix[middle], words, ends[open_])
            at[open_] = np.where(less, middle + 1, at[open_])
            high[open_] = np.where(less, high[open_], middle)
        ends, pattern = ends[at < stop], self.by_suffix[at[at < stop]]
        for j in range(self.m):  # direct comparison, word by word, of those that still agree
            same = words[ends - (self.m - 1 - j)] == self.patterns[pattern, j]
            ends, pattern = ends[same], pattern[same]
        return ends, pattern

    def _less(self, pattern: np.ndarray, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which patterns stand before the windows that end at given positions."""
        out = np.zeros(len(ends), bool)
        even = np.arange(len(ends))  # pairs that agree so far
        for j in range(self.m):
            own, other = self.patterns[pattern[even], j], words[ends[even] - (self.m - 1 - j)]
            out[even[own < other]] = True
            even = even[own == other]
        return out

    def _candidates(self, words: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Positions at which SHIFT is 0, in the order in which lanes reach them."""
        begin, end = of[:-1] + self.m - 1, of[1:]
        begin, end = begin[begin < end], end[begin < end]
        lanes = (end - begin + LANE - 1) // LANE
        nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        pos = np.repeat(begin, lanes) + nth * LANE
        stop = np.minimum(pos + LANE, np.repeat(end, lanes))
        found = [np.zeros(0, np.int64)]
        while len(pos):
            step = self.shift[self._block_hash(words[pos], words[pos - (self.block - 1)]) >> np.uint64(64 - _BITS)]
            found.append(pos[step == 0])
            pos = pos + np.maximum(step, 1)
            live = pos < stop
            pos, stop = pos[live], stop[live]
        return np.concatenate(found)


class Block:
    """Searchers for a block of benchmark items, one for each window length, and whose windows they are."""

    def __init__(self, items: list[tuple[str | None, str]], n: int):
        self.ids = [None if i is None else str(i) for i, _ in items]
        rows: dict[int, list[np.ndarray]] = {}
        whose: dict[int, list[np.ndarray]] = {}
        texts = pa.array([t for _, t in items], pa.large_string())
        for lo, _, data, offs in kernel.chunks(texts):
            data = kernel.lower_ascii(data)
            starts, ends, of = kernel.word_bounds(data, offs, kernel.ALNUM)
            words = kernel.word_hashes(data, starts, ends)
            for i in range(len(of) - 1):
                own = words[of[i] : of[i + 1]]
                if len(own):
                    windows = np.lib.stride_tricks.sliding_window_view(own, min(n, len(own)))
                    rows.setdefault(windows.shape[1], []).append(windows)
                    whose.setdefault(windows.shape[1], []).append(np.full(len(windows), lo + i))
        self.searchers, self.owners = [], []
        for m in rows:
            patterns, which = np.unique(np.concatenate(rows[m]), axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.reshape(-1), np.concatenate(whose[m])], axis=1), axis=0)
            self.searchers.append(Searcher(patterns))
            self.owners.append((np.searchsorted(pairs[:, 0], np.arange(len(patterns) + 1)), pairs[:, 1]))

    def search(self, words: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, list[set[str]]]:
        """Which words are hit, and for each text the ids of the items with a window in it."""
        hit = np.zeros(len(words) + 1, np.int32)
        items: list[set[str]] = [set() for _ in range(len(of) - 1)]
        for searcher, (first, owner) in zip(self.searchers, self.owners, strict=True):
            end, pattern = searcher.find(words, of)
            np.add.at(hit, end - (searcher.m - 1), 1)
            np.add.at(hit, end + 1, -1)
            pairs = np.unique((np.searchsorted(of, end, side="right") - 1) * np.int64(len(first)) + pattern)
            for x in pairs.tolist():
                doc, p = divmod(x, len(first))
                items[doc].update(self.ids[i] for i in owner[first[p] : first[p + 1]] if self.ids[i] is not None)
        return np.cumsum(hit[:-1]) > 0, items


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str | None, str]]]:
    block: list[tuple[str | None, str]] = []
    held = 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), F.coalesce("text", F.lit("")).alias("t")).toLocalIterator():
        if block and held + len(row["t"]) * 4 > limit:
            yield block
            block, held = [], 0
        block.append((row["i"], row["t"]))
        held += len(row["t"]) * 4
    if block:
        yield block


def hits(docs: DataFrame, benchmark: DataFrame, n: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The columns of ``docs`` (with ``text``) and a struct ``wm``: n_words, n_hit, items.

    n_words and n_hit count the text's words and those in any occurrence of a benchmark window;
    items are the ids, as strings in their order, of the benchmark items with an occurring window.
    Null and empty texts have no words. Benchmark items without words have no window; items that
    repeat a text count each; items with a null id hit words but are not listed. Repeated documents
    are each searched. An empty benchmark hits nothing; empty documents give an empty result.
    A column of ``docs`` named ``wm`` is replaced; all others pass unchanged.
    """
    spark = docs.sparkSession
    docs = docs.drop("wm")
    size = benchmark.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0]
    if (size or 0) > BENCHMARK_BYTES:
        return _joined(docs, benchmark, n)
    columns = docs.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    state = "struct<n_words: bigint, n_hit: bigint, items: array<string>, bits: binary>"
    found = docs
    blocks = _blocks(benchmark, block_bytes)  # one at a time is held here
    block = next(blocks, [])
    while block is not None:
        sent, block = spark.sparkContext.broadcast(Block(block, n)), next(blocks, None)
        found = kernel.map_arrow(found, _pass(sent, columns, block is None), f"{fields}, wm {state}")
    return found.withColumn("wm", F.col("wm").dropFields("bits"))


def _windows(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Chunk by chunk: the first text's number, the words' hashes, and the range of each text's words."""
    for lo, _, data, offs in kernel.chunks(texts):
        data = kernel.lower_ascii(data)
        starts, ends, of = kernel.word_bounds(data, offs, kernel.ALNUM)
        yield lo, kernel.word_hashes(data, starts, ends), of


def _patterns(n: int):
    """Rows (item, text) as windows: their length, hash, words and item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, words, of in _windows(batch.column(1)):
                for i in range(len(of) - 1):
                    own = words[of[i] : of[i + 1]]
                    m = min(n, len(own))
                    if m:
                        rows = np.lib.stride_tricks.sliding_window_view(own, m)
                        raw = [r.tobytes() for r in rows]
                        item = pa.array([batch.column(0)[lo + i].as_py()] * len(raw), pa.string())
                        yield pa.RecordBatch.from_arrays([pa.array([m] * len(raw), pa.int32()), pa.array(kernel.window_hashes(own, m).view(np.int64)), pa.array(raw, pa.binary()), item], names=["m", "hash", "words", "item"])

    return run


def _positions(lengths: list[int]):
    """Rows (row, text) as the hashes of all windows of given lengths, with their first word's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for lo, words, of in _windows(batch.column(1)):
                text = np.repeat(np.arange(len(of) - 1), np.diff(of))
                for m in lengths:
                    hashes = kernel.window_hashes(words, m)
                    at = np.flatnonzero(text[: len(hashes)] == text[m - 1 :]) if len(hashes) else np.zeros(0, np.int64)
                    columns = [pa.array(np.full(len(at), m, np.int32)), pa.array(hashes[at].view(np.int64)), pa.array(rows[lo + text[at]]), pa.array((at - of[text[at]]).astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, names=["m", "hash", "row", "at"])

    return run


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, text, list of (at, m, words)) as row, n_words, n_hit and the windows that do occur."""
    for batch in batches:
        rows, wanted = batch.column(0), batch.column(2)
        for lo, words, of in _windows(batch.column(1)):
            n_words, n_hit, found = [], [], []
            for i in range(len(of) - 1):
                own, hit, windows = words[of[i] : of[i + 1]], np.zeros(of[i + 1] - of[i], bool), set()
                for w in wanted[lo + i].as_py() or []:
                    if own[w["at"] : w["at"] + w["m"]].tobytes() == w["words"]:
                        hit[w["at"] : w["at"] + w["m"]] = True
                        windows.add(w["words"])
                n_words.append(len(own)); n_hit.append(int(hit.sum())); found.append(sorted(windows))  # noqa: E702
            part = rows.slice(lo, len(of) - 1)
            yield pa.RecordBatch.from_arrays([part, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(found, pa.list_(pa.binary()))], names=["row", "n_words", "n_hit", "windows"])


def _joined(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    """What :func:`hits` gives, for a benchmark that is not sent to executors."""
    key = next(c for c in map("_row{}".format, range(10**9)) if c not in docs.columns)
    rows = shared.table(docs.withColumn(key, F.monotonically_increasing_id()), "searched")
    texts = rows.select(F.col(key).alias("row"), "text")
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    patterns = shared.table(kernel.map_arrow(items, _patterns(n), "m int, hash bigint, words binary, item string").distinct(), "patterns")
    lengths = sorted(r["m"] for r in patterns.select("m").distinct().collect())  # n at most
    found = kernel.map_arrow(texts, _positions(lengths), "m int, hash bigint, row bigint, at int")
    found = found.join(patterns.select("m", "hash", "words").distinct(), ["m", "hash"]).groupBy("row").agg(F.collect_list(F.struct("at", "m", "words")).alias("found"))
    searched = texts.join(found, "row", "left").select("row", "text", "found")
    searched = shared.table(kernel.map_arrow(searched, _confirmed, "row bigint, n_words bigint, n_hit bigint, windows array<binary>"), "confirmed")
    owners = searched.select("row", F.explode("windows").alias("words")).join(patterns.select("words", "item").where("item is not null"), "words").select("row", "item").distinct()
    owners = owners.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    wm = F.struct("n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items")).alias("wm")
    result = searched.join(owners, "row", "left").select(F.col("row").alias(key + "_"), wm)
    return rows.join(result, F.col(key) == F.col(key + "_")).select(*[f"`{c}`" for c in docs.columns], "wm")


def _pass(sent, columns: list[str], last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        for batch in batches:
            text = batch.column(columns.index("text"))
            before = batch.column(len(columns)) if batch.num_columns > len(columns) else None
            out: dict[str, list] = {"n_words": [], "n_hit": [], "items": [], "bits": []}
            for lo, _, data, offs in kernel.chunks(text):
                data = kernel.lower_ascii(data)
                starts, ends, of = kernel.word_bounds(data, offs, kernel.ALNUM)
                hit, items = block.search(kernel.word_hashes(data, starts, ends), of)
                for i, own in enumerate(items):
                    bits = hit[of[i] : of[i + 1]]
                    if before is not None:
                        was = before[lo + i].as_py()
                        own |= set(was["items"])
                        if was["bits"]:
                            bits = bits | np.unpackbits(np.frombuffer(was["bits"], np.uint8), count=len(bits)).astype(bool)
                    out["n_words"].append(len(bits))
                    out["n_hit"].append(int(bits.sum()))
                    out["items"].append(sorted(own))
                    out["bits"].append(None if last or not bits.any() else np.packbits(bits).tobytes())
            types = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary())
            made = pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(columns))), made], names=[*columns, "wm"])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The documents in which no benchmark window occurs, with their columns; see :func:`hits`."""
    return hits(docs, benchmark, n).where("wm.n_hit = 0").select(*docs.columns)


def digest(ids: list[str]) -> str:
    """Lowercase hex SHA-256 of the ids, comma-joined."""
    return hashlib.sha256(",".join(ids).encode()).hexdigest()
