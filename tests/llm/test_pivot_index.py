import numpy as np

from graphloom.llm import pivot_index


def vectors(seed=0):
    r = np.random.default_rng(seed)
    rows, n = [], 0
    for size in (1, 2, 5, 40, 150):
        for _ in range(8 if size < 40 else 2):
            centre = r.normal(size=32)
            for _ in range(size):
                rows.append((n * 2, (centre + 0.2 * r.normal(size=32)).astype(np.float32).tolist()))
                n += 1
    return rows


def brute(rows):
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    return {i: int(n) for (i, _), n in zip(rows, near.sum(axis=1))}


def test_links_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(pivot_index, "BLOCK", 64)
    rows = vectors()
    got = {r["vec_id"]: r for r in pivot_index.classes(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)).collect()}
    truth = brute(rows)
    found, wanted = sum(r["n_links"] for r in got.values()), sum(truth.values())
    assert all(got[i]["n_links"] <= n for i, n in truth.items())  # none below the threshold
    assert found >= 0.98 * wanted
    for r in got.values():
        assert r["component_id"] <= r["vec_id"] and r["kept"] == (r["component_id"] == r["vec_id"])


def test_bad_vectors_repeats_and_other_columns(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 0), (2, v, 1), (2, v, 1), (3, None, 0), (4, [0.0, 0.0, 0.0], 0), (5, [1.0, None, 3.0], 0), (6, [1.0, float("nan"), 3.0], 0),
        (7, [float("inf"), 2.0, 3.0], 0), (8, [], 0), (9, [2.0, 4.0, 6.0], 2), (None, v, 0), (11, [1.0, 2.0], 0),
    ]
    got = pivot_index.classes(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, node int")).collect()
    found = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in got)
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 11)]
    assert found == sorted([(0, 0, None, True), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (9, 3, 1, False), *alone], key=lambda r: r[0])
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert pivot_index.classes(empty).count() == 0


def test_each_length_is_linked_within_itself(spark):
    long = vectors()
    r = np.random.default_rng(5)
    short = [(2 * i + 1, (c + 0.1 * r.normal(size=8)).tolist()) for i, c in enumerate(np.repeat(r.normal(size=(6, 8)), 5, axis=0))]
    pair = [(5001, [1.0, 2.0]), (5003, [2.0, 4.0]), (5005, [1.0]), (5007, [1.0, 2.0])]
    rows = [*long, *short, *pair]
    got = {r["vec_id"]: r["n_links"] for r in pivot_index.classes(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)).collect()}
    for own in (short, pair[:2] + pair[3:], pair[2:3]):
        truth = brute(own)
        assert {i: got[i] for i in truth} == truth
    truth = brute(long)
    assert all(got[i] <= n for i, n in truth.items()) and sum(got[i] for i in truth) >= 0.98 * sum(truth.values())


def test_lists_of_two_pivots_lose_nothing(spark, monkeypatch):
    df = spark.createDataFrame(vectors(3), "vec_id bigint, embedding array<float>").repartition(3)
    results = []
    for block, long, broadcast in ((1 << 20, 1 << 20, 100), (64, 64, 100), (64, 1 << 20, 100), (7, 20, 0)):
        monkeypatch.setattr(pivot_index, "BLOCK", block)
        monkeypatch.setattr(pivot_index, "LONG", long)
        monkeypatch.setattr(pivot_index, "BROADCAST_LISTS", broadcast)
        results.append(sorted(tuple(r) for r in pivot_index.classes(df).collect()))
    assert all(r == results[0] for r in results)


def test_pivots_grow_with_the_vectors():
    counts = [pivot_index.n_pivots(n, 64) for n in (1, 100, 10**6, 10**7, 10**9, 10**11)]
    assert counts == [1, 32, 2000, 4096, 9486, 94868]
    assert all(90 * n / pivot_index.n_pivots(n, 64) ** 2 <= 1024 for n in (10**6, 10**8, 10**9, 10**11))
