"""Removal of repeated substrings, by suffix sorting with a difference cover.

Every string of ``LENGTH`` bytes (a window) that also starts earlier is to be removed. Sorting all
suffixes of a corpus would move many times its size, so sorting is confined to where it can matter:

1. Each window has an anchor: of its ``GRAM``-byte grams the one of least hash, the last of equals.
   It depends on the window's bytes alone, so equal windows have equal anchors at equal offsets. The
   windows of a text that share an anchor are consecutive; their bytes are a segment (about one every
   35 bytes). A map sends each segment once, as hashes: of the anchor's gram, and of all its bytes.
   Equal segments of a batch are combined before that, however many there are.
2. Segments meet by gram. Of equal ones the first, by document and position, stays; all windows of the
   others are repeats. Grams with one distinct segment are done: its windows occur nowhere else.
3. Only segments that share a gram but differ are looked at byte by byte. Their bytes meet by gram
   again and their suffixes are sorted by a difference-cover algorithm: triples at positions not
   divisible by three are sorted and named, the order of names is found by recursion, the remaining
   suffixes are sorted by one symbol and the rank that follows, and both are merged. Adjacent
   suffixes whose first ``LENGTH`` bytes agree are one class, of which the first window stays.
   Grams whose distinct segments are very many, or too long to sort together, are dealt to tasks by
   window instead, where equal windows stand together and the first stays.
4. Repeated windows, as runs, meet their document, where covered bytes are cut out.

Steps 1 to 3 are exact for every window; nothing is sampled, and no limit on repeats holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, shared

LENGTH = 100
GRAM = 32
#: Bytes of differing segments that are sorted together (whole grams; a larger gram is sorted alone).
SORTED = 1 << 20
#: Symbols (bytes, and a divider a segment) of a gram beyond which it is dealt by window.
MOST = 1 << 21
#: Segments (40 bytes each) that a map combines before it sends them.
COMBINED = 600_000
#: Distinct segments of a gram beyond which it is dealt by window.
HOT = 50_000
#: Grams (16 bytes each) that are dealt by window up to which their list is broadcast.
BROADCAST_GRAMS = 250_000

_POS = np.uint64((1 << 20) - 1)
_TILE = 1 << 19


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    step = 1
    while step * 2 <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[: len(values) - (width - step)], values[width - step :]) if step < width else values


def segments(data: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, gram hash, bytes hash) of the segments of a chunk's texts.

    Windows are given by their start in the text. Texts over a tile's size are cut into tiles of
    windows; a segment that a cut divides is two, which step 3 of the algorithm allows.
    """
    found = []
    for base in range(0, max(len(data) - length + 1, 0), _TILE):
        part = data[base : base + _TILE + length - 1]
        sums = kernel.prefix_sums(part)
        hashes = kernel.span_hashes(sums, np.arange(len(part) - gram + 1), np.arange(gram, len(part) + 1))
        packed = (hashes & ~_POS) | (_POS - np.arange(len(hashes), dtype=np.uint64))
        anchor = (_POS - (_least(packed, length - gram + 1) & _POS)).astype(np.int64)
        at = base + np.arange(len(anchor))
        text = np.searchsorted(offs, at, side="right") - 1
        whole = at + length <= offs[text + 1]  # no window crosses the end of its text
        same = np.zeros(len(at) + 1, bool)
        same[1:-1] = whole[1:] & whole[:-1] & (anchor[1:] == anchor[:-1]) & (text[1:] == text[:-1])
        first, last = np.flatnonzero(whole & ~same[:-1]), np.flatnonzero(whole & ~same[1:])
        found.append((text[first], at[first] - offs[text[first]], at[last] - offs[text[first]], hashes[anchor[first]], kernel.span_hashes(sums, first, last + length)))
    if not found:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _runs(doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows, with runs of a document that touch made one."""
    order = np.lexsort((first, doc))
    doc, first, last = doc[order], first[order], last[order]
    start = np.ones(len(doc), bool)
    start[1:] = (doc[1:] != doc[:-1]) | (first[1:] != last[:-1] + 1)
    at = np.flatnonzero(start)
    return doc[at], first[at], last[np.append(at[1:], len(doc))[: len(at)] - 1]


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1 for (doc_id, text): rows of kind 0 are segments, of kind 1 runs of repeated windows."""
    parts: list[tuple[np.ndarray, ...]] = []
    held = 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, _, data, offs in kernel.chunks(batch.column(1)):
            text, first, last, gram, hashed = segments(data, offs)
            parts.append((ids[lo + text], first, last, gram, hashed))
            held += len(text)
        if held >= COMBINED:
            yield _combined(parts)
            parts, held = [], 0
    if parts:
        yield _combined(parts)


def _combined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """The first of each class of equal segments, and runs of the windows of the others."""
    doc, first, last, gram, hashed = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((first, doc, hashed, gram))
    doc, first, last, gram, hashed = doc[order], first[order], last[order], gram[order], hashed[order]
    head = np.ones(len(doc), bool)
    head[1:] = (gram[1:] != gram[:-1]) | (hashed[1:] != hashed[:-1])
    least = np.flatnonzero(head)[np.cumsum(head) - 1] if len(doc) else np.zeros(0, np.int64)
    again = (doc != doc[least]) | (first != first[least])
    r_doc, r_first, r_last = _runs(doc[again], first[again], last[again])
    n = np.concatenate([np.zeros(head.sum(), np.int8), np.ones(len(r_doc), np.int8)])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(n),
            pa.array(np.concatenate([gram[head].view(np.int64), kernel.mix(r_doc.astype(np.uint64)).view(np.int64)])),
            pa.array(np.concatenate([hashed[head].view(np.int64), np.zeros(len(r_doc), np.int64)])),
            pa.array(np.concatenate([doc[head], r_doc]).astype(np.int64)),
            pa.array(np.concatenate([first[head], r_first]).astype(np.int32)),
            pa.array(np.concatenate([last[head], r_last]).astype(np.int32)),
        ],
        names=["kind", "gram", "hashed", "doc", "first", "last"],
    )


_SENT = "kind tinyint, gram bigint, hashed bigint, doc bigint, first int, last int"


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2 for rows sorted by kind, gram, bytes, document and position.

    Out come runs of repeated windows (kind 1) and segments that share their gram with others (kind
    2), in constant memory: of the rows before a batch, only the first of its last class matters.
    """
    carry = None  # gram, hash, document, position and last window of the latest class, and if it was sent
    for batch in batches:
        kind, gram, hashed, doc, first, last = (batch.column(i).to_numpy() for i in range(6))
        segment = kind == 0
        done = [(np.ones((~segment).sum(), np.int8), gram[~segment], doc[~segment], first[~segment], last[~segment])]
        gram, hashed, doc, first, last = gram[segment], hashed[segment], doc[segment], first[segment], last[segment]
        if len(gram):
            held = carry is not None
            if held:
                gram, hashed, doc, first, last = (np.concatenate([[c], x]) for c, x in zip(carry[:5], (gram, hashed, doc, first, last), strict=True))
            same_gram = np.concatenate([[False], gram[1:] == gram[:-1]])
            head = ~(same_gram & np.concatenate([[False], hashed[1:] == hashed[:-1]]))
            least = np.flatnonzero(head)[np.cumsum(head) - 1]
            again = (doc != doc[least]) | (first != first[least])
            # A class is one of several if the class before or after it has its gram.
            heads = np.flatnonzero(head)
            linked = np.concatenate([[False], gram[heads[1:]] == gram[heads[:-1]]])
            several = linked | np.append(linked[1:], False)
            if held and carry[5]:
                several[0] = False  # it was sent before
            several_at = heads[several]
            done.append((np.ones(again.sum(), np.int8), gram[again], doc[again], first[again], last[again]))
            done.append((np.full(len(several_at), 2, np.int8), gram[several_at], doc[several_at], first[several_at], last[several_at]))
            end = heads[-1]
            was = bool(several[-1]) or (held and bool(carry[5]) and end == 0)
            carry = (gram[end], hashed[end], doc[end], first[end], last[end], was)
        out = [np.concatenate(c) for c in zip(*done, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1]), pa.array(out[2]), pa.array(out[3].astype(np.int32)), pa.array(out[4].astype(np.int32))], names=["kind", "gram", "doc", "first", "last"])


def suffix_ranks(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The rank of each suffix in the order of suffixes by their first ``depth`` symbols at least.

    Symbols are positive and less than 2**31, and suffixes fewer; what follows the end is less than all.
    Suffixes that agree so far stand together, in any order.
    """
    n = len(symbols)
    top = max(n, int(symbols.max(initial=0)))
    assert top < 1 << 31, "too many suffixes or symbols to pack"
    s = np.concatenate([symbols, np.zeros(6, symbols.dtype)]).astype(np.uint64)
    # Two symbols as one number below 2**42, with 22 bits left for a third or a rank; or, where that is too few, as their place.
    two, bits = (s[:-1] << np.uint64(21)) | s[1:], np.uint64(22)
    if top >= 1 << 21:
        two, bits = np.unique((s[:-1] << np.uint64(32)) | s[1:], return_inverse=True)[1].astype(np.uint64), np.uint64(32)
    triple = (two[: n + 3] << bits) | s[2 : n + 5]
    ranks = np.empty(n, np.int64)
    if depth <= 3 or n < 8:
        if n < 8:  # few suffixes: compared outright
            order = sorted(range(n), key=lambda i: symbols[i:].tolist())
        else:
            order = np.argsort(triple[:n], kind="stable")
        ranks[order] = np.arange(n)
        return ranks
    # Sample: sort triples at positions 1 and 2 modulo 3 and name them; recurse on the names. Position
    # n stands for an empty suffix where that ends the first half, so that halves do not run together.
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    order = np.argsort(triple[sample], kind="stable")
    ordered = triple[sample][order]
    names = np.empty(len(sample), np.int64)
    names[order] = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
    # A divider that is less than all names ends the first half.
    within = suffix_ranks(np.concatenate([names[: len(ones)] + 1, [1], names[len(ones) :] + 1]), -(-depth // 3) + 1)
    rank = np.zeros(n + 3, np.uint64)
    rank[ones] = within[: len(ones)] + 1
    rank[twos] = within[len(ones) + 1 :] + 1
    sample = sample[sample < n]
    sample = sample[np.argsort(rank[sample], kind="stable")]
    # The others by one symbol and the rank after it.
    rest = np.arange(0, n, 3)
    by_one = (s[: n + 1] << np.uint64(32)) | rank[1 : n + 2]
    rest = rest[np.argsort(by_one[rest], kind="stable")]
    # Merge: against position 1 mod 3 by (symbol, rank), against 2 mod 3 by (two symbols, rank).
    by_two = (two[:n] << bits) | rank[2 : n + 2]
    first, second = sample[sample % 3 == 1], sample[sample % 3 == 2]
    ranks[rest] = np.arange(len(rest)) + np.searchsorted(by_one[first], by_one[rest]) + np.searchsorted(by_two[second], by_two[rest])
    place = np.empty(n, np.int64)
    place[sample] = np.arange(len(sample))
    ranks[first] = place[first] + np.searchsorted(by_one[rest], by_one[first], side="right")
    ranks[second] = place[second] + np.searchsorted(by_two[rest], by_two[second], side="right")
    return ranks


def repeated(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, in their order, which of its windows start earlier too, in it or a text before it."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(sizes)
    # One symbol more than a byte, and a 0-like divider after each text: no valid window reaches it.
    where = np.arange(len(data)) + np.repeat(np.arange(len(texts)), sizes)
    symbols = np.ones(len(data) + len(texts), np.int64)
    symbols[where] = data.astype(np.int64) + 2
    start = np.concatenate([[0], ends[:-1]]) + np.arange(len(texts))
    valid = np.zeros(len(symbols), bool)
    for a, n in zip(start.tolist(), sizes.tolist(), strict=True):
        valid[a : a + n - length + 1] = n >= length
    order = np.argsort(suffix_ranks(symbols, length), kind="stable")
    order = order[valid[order]]
    raw = np.concatenate([symbols.astype(np.uint16).astype(np.uint8), np.zeros(8, np.uint8)])
    same = np.arange(1, len(order))  # adjacent suffixes that still agree
    for j in [*range(0, length - 7, 8), length - 8]:
        words = np.ndarray((len(raw) - 8,), "<u8", raw, strides=(1,))
        same = same[words[order[same] + j] == words[order[same - 1] + j]]
    head = np.ones(len(order), bool)
    head[same] = False
    at = np.flatnonzero(head)
    out = np.zeros(len(symbols), bool)
    if len(at):
        least = np.minimum.reduceat(order, at)[np.cumsum(head) - 1]
        out[order] = order != least
    return [out[a : a + max(n - length + 1, 0)] for a, n in zip(start.tolist(), sizes.tolist(), strict=True)]


def _bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, doc, list of (gram, first, last, hot)) as (window, key, doc, first, bytes); hot grams by window."""
    for batch in batches:
        docs, wanted = batch.column(1).to_pylist(), batch.column(2)
        for lo, _, data, offs in kernel.chunks(batch.column(0)):
            window, key, doc, first, raw = [], [], [], [], []
            for i in range(len(offs) - 1):
                own = data[offs[i] : offs[i + 1]].tobytes()
                for w in wanted[lo + i].as_py():
                    spans = [(w["gram"], w["first"], w["last"])]
                    if w["hot"]:
                        spans = [(_window_key(own[p : p + LENGTH]), p, p) for p in range(w["first"], w["last"] + 1)]
                    for k, a, b in spans:
                        if b + LENGTH <= len(own):
                            window.append(w["hot"]); key.append(k); doc.append(docs[lo + i]); first.append(a); raw.append(own[a : b + LENGTH])  # noqa: E702
            yield pa.RecordBatch.from_arrays([pa.array(window, pa.bool_()), pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(first, pa.int32()), pa.array(raw, pa.binary())], names=["window", "key", "doc", "first", "raw"])


def _window_key(window: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True)


def _sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3 for rows sorted by window, key, document and position: runs of repeated windows.

    Whole grams are sorted together up to ``SORTED``; a larger one is sorted alone. Of single windows only
    the first of each key's (several, if their hashes agree) is held.
    """
    held: list[tuple[int, int, bytes]] = []
    gram: list[tuple[int, int, bytes]] = []  # the latest gram's rows, which are not in held yet
    size = own = 0
    at = None
    least: dict[bytes, tuple[int, int]] = {}

    def runs(out: list[tuple[int, int, int]]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())], names=["doc", "first", "last"])

    def done() -> pa.RecordBatch:
        rows = sorted(held, key=lambda r: r[:2])
        out: list[tuple[int, int, int]] = []
        if len(rows) > 1:
            for (doc, first, _), again in zip(rows, repeated([r[2] for r in rows]), strict=True):
                edges = np.flatnonzero(np.diff(again, prepend=False, append=False))
                out += [(doc, first + a, first + b - 1) for a, b in edges.reshape(-1, 2).tolist()]
        return runs(out)

    for batch in batches:
        out: list[tuple[int, int, int]] = []
        for window, key, doc, first, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (window, key) != at:
                if held and size + own > SORTED:
                    yield done()
                    held, size = [], 0
                held += gram
                size += own
                gram, own, at, least = [], 0, (window, key), {}
            if window:
                if least.setdefault(raw, (doc, first)) != (doc, first):
                    out.append((doc, first, first))
            else:
                gram.append((doc, first, raw))
                own += len(raw) + 1
        if out:
            yield runs(out)
    if held and size + own > SORTED:
        yield done()
        held = []
    held += gram
    yield done()


def repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc, first, last): runs of windows of ``docs`` (doc_id, text) that also start earlier.

    Earlier is by doc_id, then by start. Rows with a null doc_id have no place in that order: they are
    left out. Rows that share a doc_id are one document's; a window that starts where its equal starts
    is not earlier, so repeated rows do not repeat each other.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null")
    met = kernel.map_arrow(docs, _sent, _SENT).repartition("gram").sortWithinPartitions("kind", "gram", "hashed", "doc", "first")
    met = shared.table(kernel.map_arrow(met, _met, "kind tinyint, gram bigint, doc bigint, first int, last int"), "segments")
    open_ = met.where("kind = 2")
    # Grams with over `hot` segments are fewer than all segments / hot, those with over MOST symbols fewer than all symbols / MOST.
    symbols = F.sum(F.col("last") - F.col("first") + F.lit(LENGTH + 1))
    sizes = open_.groupBy("gram").agg(F.count("*").alias("n"), symbols.alias("symbols"))
    large = shared.table(sizes.where((F.col("n") > hot) | (F.col("symbols") > MOST)).select("gram", F.lit(True).alias("hot")), "hot-grams")
    large = F.broadcast(large) if large.count() <= BROADCAST_GRAMS else large
    wanted = open_.join(large, "gram", "left").groupBy("doc").agg(F.collect_list(F.struct("gram", "first", "last", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("wanted"))
    raw = docs.join(wanted, docs["doc_id"] == wanted["doc"]).select("text", "doc", "wanted")
    raw = kernel.map_arrow(raw, _bytes_of, "window boolean, key bigint, doc bigint, first int, raw binary")
    more = kernel.map_arrow(raw.repartition("key").sortWithinPartitions("window", "key", "doc", "first"), _sorted, "doc bigint, first int, last int")
    return met.where("kind = 1").select("doc", "first", "last").unionByName(more)


def cut(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary: the bytes left) of every row of ``docs``.

    Texts are UTF-8 bytes (null: empty). Each byte covered by a window that also starts earlier is
    removed; overlaps count; windows are judged on the input. Texts shorter than a window and rows
    with a null doc_id lose nothing. Repeated rows stay, with the same result. An empty table gives
    an empty result; other columns are left out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = repeats(docs, hot).groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    joined = docs.select("doc_id", "text").join(runs, F.col("doc_id").cast("bigint") == F.col("doc"), "left").select("doc_id", "text", "runs")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(2)
            for lo, hi, data, offs in kernel.chunks(batch.column(1)):
                removed, spans, kept = [], [], []
                for i in range(hi - lo):
                    own = data[offs[i] : offs[i + 1]]
                    gone = np.zeros(len(own) + 1, np.int32)
                    if found[lo + i].is_valid:
                        pairs = found[lo + i].values
                        np.add.at(gone, pairs.field("first").to_numpy(), 1)
                        np.add.at(gone, np.minimum(pairs.field("last").to_numpy() + LENGTH, len(own)), -1)
                    gone = np.cumsum(gone[:-1]) > 0
                    removed.append(int(gone.sum()))
                    spans.append(int(gone[0] if len(gone) else 0) + int((gone[1:] & ~gone[:-1]).sum()))
                    kept.append(own[~gone].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offs)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return kernel.map_arrow(joined, apply, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
