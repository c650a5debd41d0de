import numpy as np
from eventide.llm import ann
from pyspark.sql import functions as F


def vectors(spark, v, ids=None):
    ids = range(len(v)) if ids is None else ids
    return spark.createDataFrame([(i, None if x is None else [None if y is None else float(y) for y in x], 0) for i, x in zip(ids, v)],
                                 "vec_id long, embedding array<float>, rank int").repartition(3)


def brute(v, ids, queries, k=5):
    out = {}
    v = np.asarray(v, np.float32).astype(np.float64)
    n = np.sqrt((v * v).sum(1))
    for i in queries:
        s = v @ v[i] / (n * n[i])
        order = sorted((j for j in range(len(v)) if ids[j] != ids[i]), key=lambda j: (-round(s[j], 12), ids[j]))[:k]
        out[ids[i]] = [(ids[j], s[j]) for j in order]
    return out


def search(df, **kw):
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0, **kw).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_small_table_is_exact(spark):
    v = np.random.default_rng(1).standard_normal((300, 16))
    exp, got = brute(v, list(range(300)), range(0, 300, 50)), search(vectors(spark, v))
    assert got.keys() == exp.keys()
    for q in exp:
        assert [x[0] for x in got[q]] == [x[0] for x in exp[q]]
        assert np.allclose([x[1] for x in got[q]], [x[1] for x in exp[q]], atol=1e-12)


def test_forest_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "wanted", lambda n: 400)
    v = np.random.default_rng(2).standard_normal((6000, 32))
    exp, got = brute(v, list(range(6000)), range(0, 6000, 50)), search(vectors(spark, v))
    hit = sum(len({x[0] for x in exp[q]} & {x[0] for x in got[q]}) for q in exp)
    assert hit >= 0.9 * 5 * len(exp)


def test_recall_holds_where_the_count_would_stop_too_deep(spark, monkeypatch):
    monkeypatch.setattr(ann, "wanted", lambda n: 3)  # as a large table fills its deep levels
    v = np.random.default_rng(6).standard_normal((6000, 32))
    exp, got = brute(v, list(range(6000)), range(0, 6000, 50)), search(vectors(spark, v))
    hit = sum(len({x[0] for x in exp[q]} & {x[0] for x in got[q]}) for q in exp)
    assert hit >= 0.95 * 5 * len(exp)


def test_blocks_of_large_arrays(spark, monkeypatch):
    v = np.random.default_rng(3).standard_normal((400, 8))
    a = search(vectors(spark, v))
    monkeypatch.setattr(ann, "wanted", lambda n: 3)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 20)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 2)
    b = search(vectors(spark, v))
    assert a.keys() == b.keys() and all(x[0][1] >= y[0][1] - 1e-12 for x, y in zip(a.values(), b.values()))


def test_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((40, 8)).tolist()
    v = [base[0]] * 60 + base + [[2 * x for x in base[0]]]
    v += [None, [0.0] * 8, [float("nan")] * 8, [float("inf")] + [1.0] * 7, [None] + [1.0] * 7, [1.0, 2.0], []]
    ids = list(range(len(v)))
    got = search(vectors(spark, v, ids))
    usable = [i for i, x in enumerate(v[:101])]
    exp = brute(np.array(v[:101]), usable, [0, 50, 100])
    assert set(got) == {0, 50, 100}
    assert [x[0] for x in got[0]] == [1, 2, 3, 4, 5] and [x[0] for x in got[50]] == [0, 1, 2, 3, 4]
    assert [x[0] for x in got[100]] == [0, 1, 2, 3, 4] == [x[0] for x in exp[100]]


def test_repeated_rows_few_candidates_and_empty(spark):
    got = search(vectors(spark, [[1, 0], [1, 0], [0, 1], [1, 1]], [0, 0, 1, 2]))
    assert [x[0] for x in got[0]] == [2, 1]
    assert search(vectors(spark, [[1, 2]], [0])) == {}
    assert search(vectors(spark, [])) == {}
    assert search(vectors(spark, [None], [0])) == {}


def test_a_rung_below_the_root_meets_fewer_rows_as_the_table_grows():
    rng = np.random.default_rng(8)
    shares = []
    for n in (2_000, 20_000, 60_000):
        v = rng.standard_normal((n, 64))
        u = v / np.linalg.norm(v, axis=1, keepdims=True)
        q = np.arange(0, n, n // 60)[:60]
        s = u[q] @ u.T
        s[np.arange(len(q)), q] = -2
        near = np.argsort(-s, axis=1)[:, :5]
        need = ann._ranks_needed(np.repeat(v[q], 5, axis=0), v[near.ravel()], ann.TREES)
        for rows in (n,) if n < 60_000 else (n, 1_000_000, 100_000_000):  # the last rungs as of ever larger tables
            level, p = ann.cheapest_rung(need, rows, ann.TREES, 128, 5)
            assert level > 0 and (need[:, level - 1] <= p).mean() >= ann.RECALL
            shares.append(1 - (1 - (p / 128) ** level) ** ann.TREES)
    assert all(a >= b for a, b in zip(shares, shares[1:])) and shares[0] > shares[2] > shares[3] > shares[4]


def test_deep_descents_score_the_same_pairs_as_a_plain_loop():
    import pyarrow as pa
    rng, dim, width, depth = np.random.default_rng(9), 16, 3, 3
    v, q = rng.standard_normal((500, dim)), rng.standard_normal((7, dim))
    table = lambda x: pa.table({"class_id": np.arange(len(x)), "v": pa.array(list(x), pa.list_(pa.float64()))})
    members = pa.Table.from_batches(list(ann._hashed(dim, 1)(table(v).to_batches())))
    queries = pa.Table.from_batches(list(ann._descents(dim, 1, depth, width)(table(q).to_batches())))
    rot = ann._rotations(dim, 1)
    own = np.stack([ann._symbols(ann._unit(v), rot[0, s]) for s in range(depth)], axis=1)
    order = [ann._likely(ann._unit(q), rot[0, s])[:, :width] for s in range(depth)]
    for level in range(1, depth + 1):
        exp = {(i, j) for i in range(7) for j in range(500) if all(own[j, s] in order[s][i] for s in range(level))}
        got, counts = set(), 0
        for symbol in np.unique(queries["symbol"].to_numpy()):
            mine = queries.filter(pa.array(queries["symbol"].to_numpy() == symbol))
            theirs = members.filter(pa.array(members["symbol"].to_numpy() == symbol))
            n = ann._levels(depth, width)(mine, theirs)
            counts += int(n["n"].to_numpy()[n["level"].to_numpy() == level].sum())
            mine = mine.append_column("level", pa.array(np.full(mine.num_rows, level, np.int32)))
            found = ann._best(dim, 500, width)(mine, theirs)
            got |= set(zip(found["query_class"].to_pylist(), found["class_id"].to_pylist()))
        assert got == exp and counts == len(exp)
