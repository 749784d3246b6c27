import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from graphloom.llm import substring_dedup as S


def brute(rows):
    """(n_bytes, n_removed, n_spans, digest) by a dictionary of all windows; ids distinct."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - 99):
            w = raw[p : p + 100]
            if w in seen:
                gone[p : p + 100] = [True] * 100
            seen.add(w)
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    return out


def corpus(seed):
    r = random.Random(seed)
    text = lambda n: "".join(r.choices("abcdefgh éñ\n", k=n))
    shared = [text(n) for n in (90, 110, 140, 300, 700)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randint(1, 4)):
            s = r.choice(shared)
            a, b = sorted(r.sample(range(len(s)), 2))
            parts += [text(r.randint(0, 120)), r.choice([s, s[a:b]])]
        rows.append((i * 2, "".join(parts)))
    rows += [(1, rows[3][1]), (3, rows[3][1]), (999, "x" * 350), (1001, "xy" * 180), (1003, ""), (1005, None), (1007, "z" * 100), (1009, "z" * 100)]
    return rows


@pytest.mark.parametrize("hot", [S.HOT, 1])
def test_against_all_windows(spark, hot):
    rows = corpus(hot)
    got = S.cut(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), hot).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got} == brute(rows)


def test_nulls_repeats_and_other_columns(spark):
    text = "".join(random.Random(1).choices("abcdef", k=250))
    rows = [(4, text, 1), (4, text, 2), (7, text, 3), (None, text, 4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, wanted int")
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in S.cut(df).collect())
    assert got == [(0, 0), (4, 0), (4, 0), (7, 250)]
    assert S.cut(df.limit(0)).count() == 0


def test_tiles_and_chunks_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(S, "_TILE", 64)
    rows = corpus(5)[:25]
    got = S.cut(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {i: x[1] for i, x in brute(rows).items()}


@pytest.mark.parametrize("size,letters,depth", [(1, 2, 100), (7, 2, 100), (50, 2, 100), (301, 1, 400), (302, 1, 400), (2000, 3, 100), (1999, 50, 100)])
def test_suffix_order(size, letters, depth):
    r = np.random.default_rng(size)
    s = r.integers(1, letters + 1, size)
    order = np.argsort(S.suffix_ranks(s, depth))
    keys = [tuple(s[i : i + depth].tolist()) for i in order]
    assert keys == sorted(keys)


@pytest.mark.parametrize("size,letters", [(400, 1 << 22), (3000, 1 << 30), (2999, 1 << 30)])
def test_suffix_order_of_wide_symbols(size, letters):
    r = np.random.default_rng(size)
    few = r.integers(1, letters, 12)
    s = few[r.integers(0, 12, size)]
    order = np.argsort(S.suffix_ranks(s, 100))
    keys = [tuple(s[i : i + 100].tolist()) for i in order]
    assert keys == sorted(keys)
    with pytest.raises(AssertionError):
        S.suffix_ranks(np.array([1 << 31] * 10), 100)


def test_suffix_order_of_many_suffixes():
    n = 6_500_000  # the ranks of two thirds of them take more than 22 bits
    s = np.random.default_rng(1).integers(1, 5, n)
    order = np.argsort(S.suffix_ranks(s, 100))
    packed = np.zeros(n, np.uint64)  # the first 26 symbols; none after the end
    for j in range(26):
        packed = packed * np.uint64(5) + np.append(s[j:], np.zeros(j, np.int64)).astype(np.uint64)
    assert np.array_equal(np.sort(order), np.arange(n))
    assert (packed[order][1:] >= packed[order][:-1]).all()


def test_long_grams_go_by_window(spark, monkeypatch):
    monkeypatch.setattr(S, "MOST", 300)
    rows = corpus(9)
    got = S.cut(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got} == brute(rows)


def test_what_is_sorted_together_is_bounded(monkeypatch):
    sorted_, whole = [], S.repeated
    monkeypatch.setattr(S, "SORTED", 1000)
    monkeypatch.setattr(S, "repeated", lambda texts: sorted_.append(sum(len(t) + 1 for t in texts)) or whole(texts))
    r = random.Random(3)
    text = lambda n: bytes(r.choices(b"abcdef", k=n))
    same, again = text(100), text(130)
    rows = [(False, 1, d, 0, text(120)) for d in range(4)]
    rows += [(False, 2, d, 0, text(120)) for d in range(15)]  # alone: 1815 symbols
    rows += [(False, 3, d, 7, again) for d in (4, 9)]
    rows += [(True, 1, d, p, same) for d in range(2000) for p in (3, 5)] + [(True, 1, 2000, 0, text(100))]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, names=["window", "key", "doc", "first", "raw"])
    found = [tuple(x.values()) for b in S._sorted(iter([batch.slice(i, 500) for i in range(0, len(rows), 500)])) for x in b.to_pylist()]
    assert sorted_ == [4 * 121, 15 * 121, 2 * 131]
    assert sorted(found) == sorted([(9, 7, 37), *((d, p, p) for d in range(2000) for p in (3, 5) if (d, p) != (0, 3))])
