"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text are rates: words and word beginnings from a lexicon, how near they stand to
second-person words, capitals, punctuation and obfuscation. The lexicon is induced from a bounded
sample of labelled texts, by smoothed log odds of the words and beginnings that toxic and clean texts
hold. For learning, the sample is in two halves and each text's features come from the other half's
lexicon; likewise the calibration is fitted to scores by trees that have not seen the text. The
executors compute counts and features; the driver sees bounded lexicons and one short row a sampled
text. Texts are scored where they are read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, shared

#: Labelled rows that are learned from, about: rows are taken by a hash of their id.
SAMPLE = 24_000
#: Entries of the lexicon at most, the best by log odds.
LEXICON = 4000
#: An entry stands in so many toxic texts at least, with such log odds.
LEAST_TEXTS, LEAST_ODDS = 3, 2.5
#: Parts of the sample that are scored in turn by trees grown on the others.
FOLDS = 3
#: Lengths in bytes of the word beginnings that can be entries.
BEGINNINGS = (4, 5, 6)
#: Words between an entry and a second-person word that count as near.
NEAR = 5

#: Second-person words in English, German, French and Spanish.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer eure sie ihnen "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro"
).split()

_SALTS = {n: np.uint64(0x9E3779B97F4A7C15 * (n + 1) & (2**64 - 1)) for n in (0, *BEGINNINGS)}


def _terms(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of whole words (n = 0), or of the first n bytes of longer words, and which words have one."""
    if n == 0:
        return kernel.span_hashes(sums, starts, ends), np.arange(len(starts))
    which = np.flatnonzero(ends - starts > n)
    return kernel.span_hashes(sums, starts[which], starts[which] + n) ^ _SALTS[n], which


class Lexicon:
    """Hashes of terms with their log odds."""

    def __init__(self, hashes: np.ndarray, odds: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.odds = hashes[order], odds[order]
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def odds_of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes))
        maybe = np.flatnonzero(self.seen[(hashes >> np.uint64(48)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
            same = self.hashes[at] == hashes[maybe]
            out[maybe[same]] = self.odds[at[same]]
        return out


def _word_list(words: list[str]) -> np.ndarray:
    data, offs = kernel.string_buffers(pa.array(words))
    return np.unique(kernel.span_hashes(kernel.prefix_sums(data), offs[:-1], offs[1:]))


NAMES = (
    "log_words", "entry_rate", "beginning_rate", "best_odds", "odds_rate", "log_hits", "near_rate", "person_rate",
    "capital_rate", "shout_rate", "exclaim_rate", "mark_rate", "digit_rate", "masked_rate", "leet_rate",
)

_IS_UPPER = np.zeros(256, bool); _IS_UPPER[65:91] = True  # noqa: E702
_IS_LETTER = _IS_UPPER.copy(); _IS_LETTER[97:123] = True; _IS_LETTER[128:] = True  # noqa: E702
_IS_DIGIT = np.zeros(256, bool); _IS_DIGIT[48:58] = True  # noqa: E702
_IS_EXCLAIM = np.zeros(256, bool); _IS_EXCLAIM[[33, 63]] = True  # noqa: E702
_IS_MASK = np.zeros(256, bool); _IS_MASK[list(b"*@$#")] = True  # noqa: E702
_IS_MARK = ~(_IS_LETTER | _IS_DIGIT | (np.arange(256) <= 32))


def features(data: np.ndarray, offs: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """One row of ``NAMES`` a text of the chunk; empty texts have zeros.

    A text that is longer than a chunk is counted piece by piece, cut between words.
    """
    if len(data) <= kernel.CHUNK:
        counted = _counts(data, offs, lexicon)
    else:
        rows = []
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
            own = [_counts(data[a + lo : a + hi], np.array([0, hi - lo]), lexicon)[0] for lo, hi in kernel.pieces(data[a:b], kernel.ALNUM)]
            rows.append(np.concatenate([np.sum(own, axis=0)[:-1], np.max(own, axis=0)[-1:]]) if own else np.zeros(_COUNTS))
        counted = np.array(rows)
    n, size, whole, begin, odds, hits, near, person, upper, letter, shout, exclaim, mark, digit, masked, leet, best = counted.T
    words, size = np.maximum(n, 1), np.maximum(size, 1)
    return np.stack([
        np.log1p(n), whole / words, begin / words, best, odds / words, np.log1p(hits), near / np.maximum(hits, 1), person / words,
        upper / np.maximum(letter, 1), shout / words, exclaim / size, mark / size, digit / size, masked / words, leet / words,
    ], axis=1)


#: Columns of :func:`_counts`.
_COUNTS = 17


def _counts(data: np.ndarray, offs: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """What the features are made of: for each text sums over its words and bytes, and the greatest odds."""
    lower = kernel.lower_ascii(data)
    starts, ends, of = kernel.word_bounds(lower, offs, kernel.ALNUM)
    sums = kernel.prefix_sums(lower)

    def per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.float64 if mask.dtype.kind == "f" else np.int64)])
        return (total[bounds[1:]] - total[bounds[:-1]]).astype(np.float64)

    whole, _ = _terms(sums, starts, ends, 0)
    odds_whole = lexicon.odds_of(whole)
    odds_begin = np.zeros(len(starts))
    for n in BEGINNINGS:
        hashes, which = _terms(sums, starts, ends, n)
        odds_begin[which] = np.maximum(odds_begin[which], lexicon.odds_of(hashes))
    odds = np.maximum(odds_whole, odds_begin)
    person = np.isin(whole, _PERSON)
    spread = np.concatenate([[0], np.cumsum(person)])
    n = len(starts)
    text = np.repeat(np.arange(len(of) - 1), np.diff(of))
    left, right = np.maximum(np.arange(n) - NEAR, of[:-1][text]), np.minimum(np.arange(n) + NEAR + 1, of[1:][text])
    near = (odds > 0) & (spread[right] > spread[left])
    upper, letter, digit = _IS_UPPER[data], _IS_LETTER[data], _IS_DIGIT[data]
    caps = np.concatenate([[0], np.cumsum(upper)])
    shout = (caps[ends] - caps[starts] == ends - starts) & (ends - starts > 1)
    mask = _IS_MASK[data]
    inner = np.zeros(len(data), bool)
    inner[1:-1] = letter[:-2] & letter[2:]
    best = np.zeros(len(of) - 1)
    np.maximum.at(best, text[odds > 0], odds[odds > 0])
    return np.stack([
        np.diff(of), np.diff(offs), per_text(odds_whole > 0, of), per_text(odds_begin > 0, of), per_text(odds, of), per_text(odds > 0, of), per_text(near, of), per_text(person, of),
        per_text(upper, offs), per_text(letter, offs), per_text(shout, of), per_text(_IS_EXCLAIM[data], offs), per_text(_IS_MARK[data], offs), per_text(digit, offs),
        per_text(mask & inner, offs), per_text(digit & inner, offs), best,
    ], axis=1).astype(np.float64)


class Trees:
    """Boosted regression trees for a binary label: logistic loss, Newton leaves, splits at quantiles."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48, least: int = 12):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least
        self.trees: list[list[tuple]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        self.least = int(max(2, min(self.least, y.sum() // 4, (1 - y).sum() // 4)))  # rare labels get small leaves
        p = min(max(y.mean(), 1e-4), 1 - 1e-4)
        self.base = float(np.log(p / (1 - p)))
        raw = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-9)
            nodes: list[tuple] = []
            self._grow(nodes, codes, cuts, grad, hess, np.arange(len(y)), self.depth)
            self.trees.append(nodes)
            raw += self._walk(nodes, x)
        return self

    def _grow(self, nodes: list[tuple], codes, cuts, grad, hess, rows: np.ndarray, depth: int) -> int:
        """Appends the subtree of ``rows``: (feature, cut, left, right), or (-1, value, 0, 0) for a leaf."""
        at = len(nodes)
        g, h = grad[rows].sum(), hess[rows].sum()
        nodes.append((-1, self.rate * g / (h + 1.0), 0, 0))
        best = (1e-6, -1, 0)
        for j, c in enumerate(cuts if depth and len(rows) >= 2 * self.least else []):
            if not len(c):
                continue
            gs, hs, ns = (np.cumsum(np.bincount(codes[rows, j], w, len(c) + 1))[:-1] for w in (grad[rows], hess[rows], None))
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(ns < self.least) | (len(rows) - ns < self.least)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), j, int(gain.argmax()))
        if best[1] >= 0:
            _, j, k = best
            low = codes[rows, j] <= k
            left = self._grow(nodes, codes, cuts, grad, hess, rows[low], depth - 1)
            right = self._grow(nodes, codes, cuts, grad, hess, rows[~low], depth - 1)
            nodes[at] = (j, float(cuts[j][k]), left, right)
        return at

    @staticmethod
    def _walk(nodes: list[tuple], x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            j, cut, left, right = nodes[at]
            if j < 0:
                out[rows] = cut
                continue
            low = x[rows, j] <= cut
            todo += [(left, rows[low]), (right, rows[~low])]
        return out

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((self._walk(t, x) for t in self.trees), np.zeros(len(x)))


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step fit of y on raw, by pooling adjacent violators."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum, count, least raw, greatest raw
    for r, v in zip(raw[order], y[order], strict=True):
        blocks.append([float(v), 1.0, float(r), float(r)])
        while len(blocks) > 1 and (blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1] or blocks[-2][3] == blocks[-1][2]):
            s, n, _, high = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2], high]
    mean = float(y.mean())  # one row at the mean is added to each block, so no score is quite 0 or 1
    knots = [(r, (s + mean) / (n + 1)) for s, n, a, b in blocks for r in dict.fromkeys((a, b))]
    return np.array([k[0] for k in knots]), np.maximum.accumulate([k[1] for k in knots])


class Model:
    def __init__(self, lexicon: Lexicon, trees: Trees | None, knots: tuple[np.ndarray, np.ndarray], prior: float):
        self.lexicon, self.trees, self.knots, self.prior = lexicon, trees, knots, prior

    def score(self, texts: pa.Array) -> np.ndarray:
        """A probability for each text, empty ones too."""
        out = [np.zeros(0)]
        for _, _, data, offs in kernel.chunks(texts):
            if self.trees is None:
                out.append(np.full(len(offs) - 1, self.prior))
            else:
                raw = self.trees.raw(features(data, offs, self.lexicon))
                out.append(np.clip(np.interp(raw, *self.knots), 0.0, 1.0))
        return np.concatenate(out)


_EMPTY = Lexicon(np.zeros(0, np.uint64), np.zeros(0))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns ``toxic`` of ``labels`` (doc_id, toxic) from the texts of ``docs`` (doc_id, text).

    Labels with a null id or label and those without a document teach nothing; an id that repeats
    teaches once a row. With no rows, or of one class only, every score is that class's share.
    """
    spark = docs.sparkSession
    labels = labels.where("doc_id is not null and toxic is not null").select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    n = labels.count()
    share = min(1.0, sample / max(n, 1))
    # At most about `sample` rows of 12 bytes are broadcast.
    some = labels.where(shared.lowest(F.xxhash64("label_id", F.lit(7)), share)).withColumn("half", F.pmod(F.xxhash64("label_id", F.lit(8)), F.lit(100)))
    texts = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("label_id")).select("text", "toxic", "half").persist()
    try:
        lexicon, *halves = (_induce(texts.where(w)) for w in ("true", "half < 50", "half >= 50"))
        sent = spark.sparkContext.broadcast(halves)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                half = np.array(batch.column(2).to_pylist(), np.int64)
                other = [[features(data, offs, x) for _, _, data, offs in kernel.chunks(batch.column(0))] for x in sent.value]
                low, high = (np.concatenate(x) if x else np.zeros((0, len(NAMES))) for x in other)
                x = np.where((half < 50)[:, None], high, low)
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), batch.column(1), batch.column(2)], names=[*NAMES, "toxic", "half"])

        schema = ", ".join(f"{c} double" for c in NAMES) + ", toxic int, half bigint"
        got = kernel.map_arrow(texts, rows, schema).toPandas().sort_values(["half", "toxic", *NAMES], kind="stable")
    finally:
        texts.unpersist()
    x, y, fold = got[list(NAMES)].to_numpy(), (got["toxic"].to_numpy() > 0).astype(float), got["half"].to_numpy() % FOLDS
    prior = float(y.mean()) if len(y) else 0.0
    if any(len(set(y[fold != f].tolist())) < 2 for f in range(FOLDS)):
        return Model(_EMPTY, None, (np.zeros(1), np.zeros(1)), prior)
    raw = np.zeros(len(y))
    for f in range(FOLDS):
        raw[fold == f] = Trees().fit(x[fold != f], y[fold != f]).raw(x[fold == f])
    return Model(lexicon, Trees().fit(x, y), isotonic(raw, y), prior)


def _induce(texts: DataFrame) -> Lexicon:
    """Terms that toxic texts hold far more often than clean ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.array(batch.column(1).to_pylist(), np.int64)
            for lo, _, data, offs in kernel.chunks(batch.column(0)):
                data = kernel.lower_ascii(data)
                cut = [(0, len(data), offs)] if len(data) <= kernel.CHUNK else [(a, b, np.array([0, b - a])) for a, b in kernel.pieces(data, kernel.ALNUM)]
                pairs = np.unique(np.concatenate([_pairs(data[a:b], bounds) for a, b, bounds in cut])) if len(cut) > 1 else _pairs(data, offs)
                term, at = np.unique(pairs["term"], return_inverse=True)
                bad = toxic[lo + pairs["text"].astype(np.int64)] > 0
                n_bad = np.bincount(at[bad], minlength=len(term))
                n_all = np.bincount(at, minlength=len(term))
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n_bad), pa.array(n_all - n_bad)], names=["term", "bad", "good"])

    sizes = texts.groupBy().agg(F.sum(F.col("toxic")).alias("bad"), F.count("*").alias("n")).first()
    bad = float(sizes["bad"] or 0)
    good = float(sizes["n"]) - bad
    odds = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    best = (
        kernel.map_arrow(texts, count, "term bigint, bad bigint, good bigint")
        .groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where(F.col("bad") >= LEAST_TEXTS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
        .orderBy(F.desc("odds"), "term").limit(LEXICON).select("term", "odds").toPandas()
    )
    return Lexicon(best["term"].to_numpy().astype(np.int64).view(np.uint64), best["odds"].to_numpy())


def _pairs(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The distinct terms of each text of a chunk, in lower case."""
    starts, ends, of = kernel.word_bounds(data, offs, kernel.ALNUM)
    sums = kernel.prefix_sums(data)
    text = np.repeat(np.arange(len(of) - 1), np.diff(of)).astype(np.uint64)
    found = [_terms(sums, starts, ends, n) for n in (0, *BEGINNINGS)]
    pairs = np.zeros(sum(len(h) for h, _ in found), [("term", np.uint64), ("text", np.uint64)])
    pairs["term"], pairs["text"] = np.concatenate([h for h, _ in found]), np.concatenate([text[w] for _, w in found])
    return np.unique(pairs)


_PERSON = _word_list(SECOND_PERSON)


def score(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """The columns of ``docs`` (with ``text``) and a double ``name``, 0 to 1, for each whole text.

    Null and empty texts have the score of a text without words. Repeated rows stay; an empty table
    gives an empty result; a column that is called ``name`` already is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(name)
    at = docs.columns.index("text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sent.value.score(batch.column(at)))], names=[*batch.schema.names, name])

    return kernel.map_arrow(docs, run, f"{fields}, `{name}` double")
