import random
import re

import numpy as np
import pyarrow as pa
import pytest

from graphloom.llm import components, kernel, near_dedup


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def brute(rows, k, percent=80):
    """component_id by comparing all pairs; rows of (id, text) with distinct ids."""
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def corpus(seed=1):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    for size in (3, 5, 20, 60, 200, 700):
        base = r.choices(vocabulary, k=size)
        for _ in range(14):
            text = list(base)
            for _ in range(r.randint(0, max(1, size // 25))):
                text[r.randrange(size)] = r.choice(vocabulary)
            sep = r.choice([" ", "\n", "  ", "\t"])
            rows.append((n * 3 + 1, sep.join(t.upper() if r.random() < 0.1 else t for t in text)))
            n += 1
    rows += [(1000, ""), (1001, None), (1002, "  \n "), (1003, "one"), (1004, "ONE"), (1005, "one two"), (1006, "é É"), (1007, "É é")]
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_against_all_pairs(spark, k):
    rows = corpus(k)
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id bigint, text string"), k, 80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, k)


def test_blocks_give_the_same_classes(spark, monkeypatch):
    rows = corpus(7)
    monkeypatch.setattr(near_dedup, "BLOCK", 1500)
    monkeypatch.setattr(near_dedup, "SKETCHES", 3)
    monkeypatch.setattr(near_dedup, "BROADCAST_NODES", 0)
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, 4)


def test_nulls_repeats_and_other_columns(spark):
    rows = [(5, "a b c d e f", "x"), (5, "a b c d e f", "y"), (2, "a b c d e f", None), (None, "a b c d e f", "z"), (9, "q r s t u", "n")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, node string").withColumnRenamed("node", "bands")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"], r["kept"]) for r in near_dedup.classes(df, 4).collect())
    assert got == [(False, 2, 2, True), (False, 5, 2, False), (False, 5, 2, False), (False, 9, 9, True), (True, 0, None, True)]
    left = near_dedup.representatives(df, 4).collect()
    assert sorted((r["doc_id"] or 0) for r in left) == [0, 2, 9]
    assert near_dedup.classes(df.limit(0), 4).count() == 0


def test_hot_group_of_copies(spark):
    rows = [(i, "the same words in every one of these documents today") for i in range(3000)]
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), 4)
    assert got.where("component_id = 0").count() == 3000
    assert got.where("kept").count() == 1


def test_estimates_are_close():
    r = np.random.default_rng(3)
    for share in (0.3, 0.6, 0.8, 0.95):
        common, own = int(800 * share), int(800 * (1 - share) / 2)
        x = kernel.mix(r.integers(0, 1 << 63, common + 2 * own, dtype=np.uint64))
        a, b = np.sort(x[: common + own]), np.sort(np.concatenate([x[:common], x[common + own :]]))
        truth = common / (common + 2 * own)
        found = near_dedup.estimate(near_dedup.sketch(a), len(a), near_dedup.sketch(b)[None], np.array([len(b)]))[0]
        assert abs(found - truth) < 0.15


def test_sketches_merge():
    r = np.random.default_rng(4)
    x = kernel.mix(r.integers(0, 1 << 63, 500, dtype=np.uint64))
    merged = np.maximum(near_dedup.sketch(x[:300]), near_dedup.sketch(x[200:]))
    assert (merged == near_dedup.sketch(x)).all()


def test_hashes_do_not_depend_on_place():
    texts = pa.array(["aa b aa", None, "", "b  aa"])
    (_, _, data, offs), = list(kernel.chunks(texts))
    starts, ends, of = kernel.word_bounds(data, offs, kernel.NOT_SPACE)
    h = kernel.word_hashes(data, starts, ends)
    assert of.tolist() == [0, 3, 3, 3, 5]
    assert h[0] == h[2] == h[4] and h[1] == h[3] and h[0] != h[1]


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 102), (100, 102), (200, 200)]
    got = {r["node"]: r["root"] for r in components.connect(spark.createDataFrame(links, "x bigint, y bigint")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {101: 100, 102: 100}
    assert components.connect(spark.createDataFrame([], "x bigint, y bigint")).count() == 0


def _components(sets, links):
    root = list(range(len(sets)))
    for a, b in links:
        root = [root[b] if x == root[a] else x for x in root]
    return {tuple(i for i, x in enumerate(root) if x == c) for c in set(root)}


def _all_pairs(sets):
    pairs = [(a, b) for a in range(len(sets)) for b in range(a)]
    return [(a, b) for a, b in pairs if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))]


def test_chains_in_any_order():
    for seed in range(60):
        r = np.random.default_rng(seed)
        pool = kernel.mix(r.integers(0, 1 << 63, 190, dtype=np.uint64))
        chain = [np.sort(pool[10 * i : 10 * i + 100]) for i in r.permutation(10)]  # only neighbours reach 80 %
        assert len(_all_pairs(chain)) == 9
        assert _components(chain, near_dedup.confirm(chain, 80)) == {tuple(range(10))}


def test_bridged_stars_in_any_order():
    for seed in range(60):
        r = np.random.default_rng(seed)
        pool = kernel.mix(r.integers(0, 1 << 63, 320, dtype=np.uint64))
        # Two hubs that are far apart, leaves that lack shingles of their hub, and a leaf of each that bridges.
        hubs = [pool[:100], pool[30:130]]
        stars = [np.delete(h, r.permutation(60)[:18] + o) for h, o in zip(hubs, (0, 40), strict=True) for _ in range(6)]
        bridge = [pool[10:110], pool[20:120]]
        sets = [np.sort(s) for s in [*hubs, *stars, *bridge, pool[200:300]]]
        sets = [sets[i] for i in r.permutation(len(sets))]
        assert _components(sets, near_dedup.confirm(sets, 80)) == _components(sets, _all_pairs(sets))


def test_texts_that_share_an_id(spark):
    a, b, c = ("a b c d e f g", "q r s t u v w", "h i j k l m n")
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(5, a), (5, b), (3, b), (5, a), (7, near), (7, near + " x"), (8, a), (9, ""), (9, None), (9, ""), (9, c), (None, c), (None, c), (2, "w1")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    left = [(r["doc_id"], r["text"]) for r in near_dedup.representatives(df, 4).collect()]
    sevens = [x for x in left if x[0] == 7]
    assert len(sevens) == 1 and sevens[0] in rows
    assert sorted((x for x in left if x[0] != 7), key=str) == sorted([(5, a), (3, b), (9, ""), (9, None), (9, c), (None, c), (2, "w1")], key=str)


def test_chains_and_bridges_across_buckets(spark):
    """Links between texts that are not near their buckets' least nodes, in any order."""
    rows = []
    for seed in range(12):
        r = np.random.default_rng(seed)
        words = [f"s{seed}w{i}" for i in range(400)]
        chain = [" ".join(words[6 * i : 6 * i + 70]) for i in range(12)]  # only neighbours reach 80 %
        hubs = [" ".join(words[200 + 25 * h : 290 + 25 * h]) for h in range(3)]
        rows += [(int(1000 * seed + i), t) for i, t in enumerate(r.permutation(chain + hubs + chain[:2]).tolist())]
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), 4, 80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, 4)


def test_pairs_are_tested_where_they_first_meet():
    r = np.random.default_rng(5)
    pool = kernel.mix(r.integers(0, 1 << 63, 130, dtype=np.uint64))
    a, b = np.sort(pool[:120]), np.sort(pool[8:128])
    same = np.flatnonzero(near_dedup.band_keys(near_dedup.sketch(a)) == near_dedup.band_keys(near_dedup.sketch(b)))
    assert [i for i in range(near_dedup.BANDS) if near_dedup.confirm([a, b], 80, band=i)] == same[:1].tolist()
    assert near_dedup.confirm([a, b], 80, np.array([0, 0])) == [] and len(near_dedup.confirm([a, b], 80, np.array([0, 1]))) == 1
