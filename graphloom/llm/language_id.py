"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a space, and bigrams and trigrams of the code
points are hashed to ``BINS`` bins. A bounded sample of labelled texts gives the counts, summed on the
executors; the matrix of log probabilities (``BINS`` rows, a column a language) is broadcast, and each
batch of texts is scored with numpy by gathering and adding the rows of its n-grams. Whole texts are
scored where they are read; only the sample's counts are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel, shared

BINS = 1 << 16
#: Labelled texts of a language that are learned from, about: texts are taken by a hash of their id.
PER_LANGUAGE = 4000
#: Languages that are learned, at most: those with most texts. Each takes half a megabyte of the broadcast matrix.
LANGUAGES = 200
#: Additive smoothing of the counts.
ALPHA = 0.05
#: n-grams that speak for a text's score at most, whatever its length, so that scores differ.
EVIDENCE = 60.0

_BATCH = 1 << 19


class _Letters:
    table: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if _Letters.table is None:
        _Letters.table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _Letters.table


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of n-grams, the text of each, and for each text its count of letters."""
    texts = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    # A space before and after each text, so that no n-gram crosses a border.
    code = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    letter = _letters()[code]
    code = np.where(letter, code, np.uint64(32))
    of = np.repeat(np.arange(len(texts)), sizes + 1)
    letters = np.bincount(of[letter[1:]], minlength=len(texts))
    with np.errstate(over="ignore"):
        pair = code[:-1] * np.uint64(0x9E3779B97F4A7C15) + code[1:]
        triple = pair[:-1] * np.uint64(0xBF58476D1CE4E5B9) + code[2:]
    two = letter[:-1] | letter[1:]
    three = letter[1:-1]
    bins = np.concatenate([kernel.mix(pair[two]), kernel.mix(triple[three] + np.uint64(1))]) >> np.uint64(48)
    # The n-gram that ends with the space after text i counts for text i.
    own = np.concatenate([of[np.minimum(np.flatnonzero(two), len(of) - 1)], of[np.flatnonzero(three)]])
    return bins.astype(np.int64), own, letters


def _batches(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    for lo, _, data, offs in kernel.chunks(column, _BATCH):
        yield lo, [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offs[:-1], offs[1:], strict=True)]


def _parts(texts: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(number of the text, part) in lists of about ``_BATCH`` characters. Longer texts are cut at white space, where no n-gram is lost."""
    of, parts, held = [], [], 0
    for i, text in enumerate(texts):
        lo = 0
        while True:
            hi = len(text)
            if hi - lo > _BATCH:
                blank = text.rfind(" ", lo, lo + _BATCH)
                hi = blank if blank > lo else lo + _BATCH
            of.append(i)
            parts.append(text[lo:hi])
            held += hi - lo
            if held >= _BATCH:
                yield np.array(of), parts
                of, parts, held = [], [], 0
            if hi >= len(text):
                break
            lo = hi + (text[hi] == " ")
    if parts:
        yield np.array(of), parts


class Model:
    def __init__(self, langs: list[str], prior: np.ndarray, logs: np.ndarray):
        self.langs, self.prior, self.logs = langs, prior, logs

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        n, letters, total = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.langs)))
        for of, parts in _parts(texts):
            bins, own, found = _grams(parts)
            own = of[own]
            n += np.bincount(own, minlength=len(texts))
            letters += np.bincount(of, found, len(texts)).astype(np.int64)
            total += np.stack([np.bincount(own, self.logs[:, k][bins], len(texts)) for k in range(len(self.langs))], axis=1)
        best = (total + self.prior).argmax(axis=1)
        weight = np.minimum(1.0, EVIDENCE / np.maximum(n, 1))[:, None]
        scaled = total * weight + self.prior * weight
        scaled = np.exp(scaled - scaled.max(axis=1, keepdims=True))
        score = scaled[np.arange(len(texts)), best] / scaled.sum(axis=1)
        return [self.langs[b] if k else "und" for b, k in zip(best, letters, strict=True)], np.where(letters > 0, score, 0.0)


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> Model:
    """Learns from ``text`` and ``lang`` of ``labelled`` (doc_id only picks the sample).

    Rows with a null text or lang teach nothing. Nothing to learn from: a model that says ``und``.
    A language's texts are all taken if it has ``per_language`` or fewer, else about so many. Of more
    than ``languages`` values of lang, those with most texts are learned (of equals, the first by name).
    """
    known = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros(0), np.zeros((BINS, 0)))
    of = {lang: k for k, lang in enumerate(langs)}
    share = {lang: min(1.0, per_language / sizes[lang]) for lang in langs}
    # The highest hash of a sampled row, by language.
    highest = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(int(share[lang] * 2.0**64), (1 << 64) - 1) - (1 << 63))])
    sample = known.where(F.xxhash64("doc_id") <= highest[F.col("lang")]).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), BINS), np.int64)
        for batch in batches:
            which = np.array([of[x] for x in batch.column(1).to_pylist()], np.int64)
            for lo, texts in _batches(batch.column(0)):
                for part_of, parts in _parts(texts):
                    bins, own, _ = _grams(parts)
                    total += np.bincount(which[lo + part_of[own]] * BINS + bins, minlength=total.size).reshape(total.shape)
        lang, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang * BINS + at), pa.array(total[lang, at])], names=["cell", "n"])

    # One row a language and bin at most comes to the driver.
    cells = kernel.map_arrow(sample, count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(langs) * BINS)
    counts[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    counts = counts.reshape(len(langs), BINS) + ALPHA
    prior = np.array([float(sizes[lang]) for lang in langs])
    return Model(langs, np.log(prior / prior.sum()), np.ascontiguousarray(np.log(counts / counts.sum(axis=1, keepdims=True)).T))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1, of that language) for every row of ``docs``.

    Null texts and texts without a letter are ``und`` with score 0; bytes that are no UTF-8 are no letters. Null doc_ids and repeated rows
    stay, row by row; other columns are left out; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang: list[str] = []
            score = [np.zeros(0)]
            for _, texts in _batches(batch.column(1)):
                a, b = sent.value.predict(texts)
                lang += a
                score.append(b)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(np.concatenate(score))], names=["doc_id", "lang_pred", "score"])

    return kernel.map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double")
