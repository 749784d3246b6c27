"""Byte-level BPE encoding and decoding with recursive DuckDB queries in each partition.

Texts are split by the tokenizer's pattern. Pieces that are tokens themselves need no merges; the
others, each distinct one once, become rows (piece, position, token) of single bytes. A recursive
query joins neighbouring rows with the merge table and contracts, in each piece, the leftmost pair of
least rank, until no piece has a pair left. In long pieces, steps that only repeat are taken at once:
where no pair with the new token can have a smaller rank (the merge table tells), the next leftmost
least pairs are the other disjoint occurrences of the same pair, and all are contracted together. Long
pieces are cut first where two bytes meet that do so in no token, as no merge can cross such a place.

Decoding is an ordered aggregation: rows (text, position, token) join the vocabulary and their bytes
are concatenated by position.

A Python worker keeps the pieces it has encoded, a bounded number, from task to task. Nothing
is shuffled, and the vocabulary, a file of known size, is all that is sent to executors.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import kernel

#: Distinct pieces that a worker remembers (about 200 bytes each) in each of two generations, and the longest of them.
CACHE_PIECES, CACHE_BYTES = 200_000, 256
#: Memory of a worker's DuckDB, beyond which it writes to its own temporary folder.
DUCKDB_MEMORY = "160MB"
#: Rows (bytes of new pieces; tokens) that one query takes; a longer piece or text is a query of its own.
QUERY_ROWS = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tiktoken file; read on the driver."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


#: Characters of a text beyond which its pieces are taken some at a time.
LONG = 4 << 20
#: Pieces of up to this many bytes contract one pair a step.
SHORT = 64

# A piece's state is the list of its tokens. Each step unnests the lists to rows (piece, position,
# token, follower), joins them with the merges, and contracts each piece's least (rank, position).
_LEFTMOST = """
    WITH RECURSIVE state(piece, tokens, live) AS (
        SELECT piece, tokens, true FROM pieces
        UNION ALL
        SELECT s.piece, CASE WHEN least IS NULL THEN tokens ELSE tokens[:(least & 16777215) - 1] || [(least >> 24)::INT] || tokens[(least & 16777215) + 2:] END,
               least IS NOT NULL
        FROM (SELECT * FROM state WHERE live) s LEFT JOIN (
            SELECT piece, min(made::BIGINT << 24 | pos) AS least
            FROM (
                SELECT piece, unnest(range(1, len(tokens))) AS pos, unnest(tokens[:-2]) AS token, unnest(tokens[2:]) AS follower FROM state WHERE live
            ) JOIN merges ON token = l AND follower = r
            GROUP BY piece
        ) USING (piece)
    )
    SELECT tokens FROM state WHERE NOT live ORDER BY piece"""

# For long pieces, the same with rows as state: all disjoint occurrences of the least pair are contracted in a step, from the left
# (in a run of occurrences that overlap, every other one), where its token allows; a contracted
# follower keeps its key with a null token, so that the state has one row a byte at any time.
_EVERY = """
    WITH RECURSIVE state(piece, pos, token, live) USING KEY (piece, pos) AS (
        SELECT piece, pos, token, true FROM rows
        UNION ALL
        SELECT piece, pos, CASE WHEN take THEN least WHEN NOT gone THEN token END, least IS NOT NULL
        FROM (
            SELECT *, lag(take, 1, false) OVER (PARTITION BY piece ORDER BY pos) AS gone
            FROM (
                SELECT *, hit AND CASE WHEN every THEN row_number() OVER (PARTITION BY piece, hit, n - hits ORDER BY pos) % 2 = 1 ELSE pos = first END AS take
                FROM (
                    SELECT *, sum(hit::INT) OVER (PARTITION BY piece ORDER BY pos ROWS UNBOUNDED PRECEDING) AS hits,
                           min(CASE WHEN hit THEN pos END) OVER (PARTITION BY piece) AS first
                    FROM (
                        SELECT *, coalesce(made = least, false) AS hit
                        FROM (
                            SELECT s.*, made, every, min(made) OVER (PARTITION BY piece) AS least
                            FROM (
                                SELECT piece, pos, token, lead(token) OVER positions AS follower, row_number() OVER positions AS n
                                FROM state WHERE live AND token IS NOT NULL WINDOW positions AS (PARTITION BY piece ORDER BY pos)
                            ) s LEFT JOIN merges ON token = l AND follower = r
                        )
                    )
                )
            )
        )
    )
    SELECT piece, token FROM state WHERE token IS NOT NULL ORDER BY piece, pos"""


class Tokenizer:
    """Encoder and decoder for one vocabulary, with its own in-memory database."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split, self.pieces = regex.compile(pattern).findall, regex.compile(pattern).finditer
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        merges = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, made = (np.array(c, np.int32) for c in zip(*merges, strict=True)) if merges else (np.zeros(0, np.int32),) * 3
        # Making a token never makes a smaller pair, unless the token is part of one of smaller rank.
        spoilt = np.union1d(left[left > made], right[right > made])
        # No merge crosses a border between two bytes that stand beside each other in no token.
        data, ends = np.frombuffer(b"".join(ranks), np.uint8), np.cumsum([len(t) for t in ranks])
        inside = np.ones(len(data), bool)
        inside[ends - 1] = False
        self.beside = np.zeros((256, 256), bool)
        self.beside[data[:-1][inside[:-1]], data[1:][inside[:-1]]] = True
        spill = tempfile.gettempdir()  # the worker's own
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "preserve_insertion_order": False, "temp_directory": spill})
        self.db.execute("SET enable_progress_bar = false")
        self._load("merge_rows", pa.table({"l": left, "r": right, "made": made, "every": ~np.isin(made, spoilt)}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")
        self._load("vocab_rows", pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]}))
        self.db.execute("CREATE TABLE vocab AS SELECT * FROM vocab_rows")
        #: Ids of pieces: those seen since the cache was last full, and those of the time before.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _load(self, name: str, rows: pa.Table) -> None:
        self.db.register(name, rows)

    def _merge(self, pieces: list[bytes], every: bool) -> list[bytes]:
        """The ids of each piece, as little-endian unsigned 32-bit integers."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        tokens = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.arange(len(pieces), dtype=np.int32)
        if every:
            pos = np.arange(len(tokens)) - np.repeat(ends - sizes, sizes)
            self._load("rows", pa.table({"piece": np.repeat(piece, sizes), "pos": pos.astype(np.int32), "token": tokens}))
            result = self.db.execute(_EVERY).fetchnumpy()
            raw = result["token"].astype("<u4").tobytes()
            bounds = np.searchsorted(result["piece"], np.arange(len(pieces) + 1))
        else:
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(tokens))
            self._load("pieces", pa.table({"piece": piece, "tokens": lists}))
            result = self.db.sql(_LEFTMOST).to_arrow_table().column(0).combine_chunks()
            raw = result.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            bounds = np.concatenate([[0], np.cumsum(result.value_lengths().to_numpy())])
        return [raw[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def _parts(self, raw: bytes) -> list[bytes]:
        """A piece, cut where no merge can cross."""
        data = np.frombuffer(raw, np.uint8)
        cuts = (np.flatnonzero(~self.beside[data[:-1], data[1:]]) + 1).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], [*cuts, len(raw)], strict=True)]

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of new pieces."""
        found: dict[str | bytes, bytes] = {}  # of parts of long pieces too, by their bytes
        long: list[tuple[str, list[bytes]]] = []
        todo: dict[bool, tuple[list[str | bytes], list[bytes]]] = {False: ([], []), True: ([], [])}
        held = {False: 0, True: 0}

        def add(name: str | bytes, raw: bytes) -> None:
            every = len(raw) > SHORT
            if held[every] + len(raw) > QUERY_ROWS:
                merge(every)
            todo[every][0].append(name)
            todo[every][1].append(raw)
            held[every] += len(raw)

        def merge(every: bool) -> None:
            names, raws = todo[every]
            if names:
                found.update(zip(names, self._merge(raws, every), strict=True))
            todo[every], held[every] = ([], []), 0

        for piece in pieces:
            raw = piece.encode()
            if (rank := self.ranks.get(raw)) is not None:
                found[piece] = rank.to_bytes(4, "little")
            elif len(raw) <= SHORT:
                add(piece, raw)
            else:
                long.append((piece, self._parts(raw)))
        for part in {part for _, own in long for part in own}:
            add(part, part)
        merge(False)
        merge(True)
        found.update([(piece, b"".join(map(found.__getitem__, own))) for piece, own in long])
        for part in {part for _, own in long for part in own}:
            del found[part]
        return found

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers; no special tokens."""
        if any(len(t) > LONG for t in texts):
            return [self._encode_long(t) if len(t) > LONG else self._encode([self.split(t)])[0] for t in texts]
        return self._encode([self.split(t) for t in texts])

    def _encode_long(self, text: str) -> bytes:
        """The same for a long text, some pieces at a time."""
        found = (m[0] for m in self.pieces(text))
        return b"".join(self._encode([some])[0] for some in iter(lambda: list(itertools.islice(found, QUERY_ROWS)), []))

    def _encode(self, split: list[list[str]]) -> list[bytes]:
        """The ids of each list of pieces."""
        unseen = set(itertools.chain.from_iterable(split)).difference(self.cache)
        again = {p: self.older[p] for p in unseen if p in self.older}
        new = again | self._learn([p for p in unseen if p not in again])
        if len(self.cache) + len(new) > CACHE_PIECES:
            # Pieces that turn up again later move back from the older ones.
            needed = set(itertools.chain.from_iterable(split)).difference(new)
            self.older, self.cache = self.cache, {p: self.cache[p] for p in needed}
        self.cache.update(new)
        get = self.cache.__getitem__
        out = [b"".join(map(get, pieces)) for pieces in split]
        for p in [p for p in new if len(p) > CACHE_BYTES]:
            del self.cache[p]
        return out

    def decode_batch(self, encoded: list[bytes]) -> list[bytes]:
        """The bytes of each text's ids; long lists of ids are decoded in slices."""
        size = 4 * QUERY_ROWS
        slices = [(i, e[lo : lo + size]) for i, e in enumerate(encoded) for lo in range(0, max(len(e), 1), size)]
        out: list[list[bytes]] = [[] for _ in encoded]
        for (i, _), raw in zip(slices, self._decode([e for _, e in slices]), strict=True):
            out[i].append(raw)
        return [b"".join(parts) for parts in out]

    def _decode(self, encoded: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        lo = 0
        while lo < len(encoded):
            hi, held = lo, 0
            while hi < len(encoded) and (hi == lo or held + len(encoded[hi]) // 4 <= QUERY_ROWS):
                held += len(encoded[hi]) // 4
                hi += 1
            ids = np.frombuffer(b"".join(encoded[lo:hi]), "<u4").astype(np.int32)
            text = np.repeat(np.arange(hi - lo, dtype=np.int32), [len(e) // 4 for e in encoded[lo:hi]])
            self._load("tokens", pa.table({"text": text, "pos": np.arange(len(ids), dtype=np.int32), "id": ids}))
            got = dict(self.db.execute("SELECT text, string_agg(hex, '' ORDER BY pos) FROM tokens JOIN vocab USING (id) GROUP BY text").fetchall())
            out += [bytes.fromhex(got.get(i, "")) for i in range(hi - lo)]
            lo = hi
        return out


#: One tokenizer a worker process, with its cache, for as long as the vocabulary is the same.
_held: dict[int, Tokenizer] = {}


def _tokenizer(sent, pattern: str) -> Tokenizer:
    ranks = sent.value
    key = hash((len(ranks), pattern, hashlib.sha256(repr(list(ranks.items())[-50:]).encode()).digest()))
    if key not in _held:
        _held.clear()
        _held[key] = Tokenizer(ranks, pattern)
    return _held[key]


def map_texts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, schema: str, make: Callable[[Tokenizer, list[str]], list[pa.Array]], keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` and what ``make`` gives for a batch of texts (null: empty)."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    fields = [f"`{docs.schema[c].name}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    at = docs.columns.index("text")
    kept = [docs.columns.index(c) for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(sent, pattern)
        for batch in batches:
            for lo, hi, data, offs in kernel.chunks(batch.column(at)):
                texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:], strict=True)]
                made = make(tokenizer, texts)
                part = batch.slice(lo, hi - lo)
                names = [*keep, *(f"made{i}" for i in range(len(made)))]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), *made], names=names)

    names = [x.strip().split()[0] for x in schema.split(",")]
    types = [x.strip().split()[1] for x in schema.split(",")]
    out = kernel.map_arrow(docs, run, ", ".join([*fields, *(f"made{i} {t}" for i, t in enumerate(types))]))
    return out.select(*keep, *(out[f"made{i}"].alias(n) for i, n in enumerate(names)))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id and ids (binary: little-endian unsigned 32-bit integers) of every whole text.

    Null and empty texts have no ids; bytes that are no UTF-8 are read as U+FFFD. Null doc_ids and repeated rows stay, row by row; an empty table
    gives an empty result. Other columns, whatever their names, are left out.
    """
    make = lambda tok, texts: [pa.array(tok.encode_batch(texts), pa.binary())]
    return map_texts(docs, ranks, pattern, "ids binary", make, ["doc_id"])


def tokenized(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: list[str]) -> DataFrame:
    """``keep`` columns, n_tokens, ids (binary, as in :func:`encode`) and decoded_sha256, which tells that decoding gives the text back."""

    def make(tok: Tokenizer, texts: list[str]) -> list[pa.Array]:
        ids = tok.encode_batch(texts)
        back = [hashlib.sha256(b).hexdigest() for b in tok.decode_batch(ids)]
        return [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(back, pa.string())]

    return map_texts(docs, ranks, pattern, "n_tokens bigint, ids binary, decoded_sha256 string", make, keep)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text, encoded and decoded again; cases as in :func:`encode`."""

    def make(tok: Tokenizer, texts: list[str]) -> list[pa.Array]:
        ids = tok.encode_batch(texts)
        back = tok.decode_batch(ids)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        return [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(map(sha, ids), pa.string()), pa.array(map(sha, back), pa.string())]

    return map_texts(docs, ranks, pattern, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", make, ["doc_id"])
