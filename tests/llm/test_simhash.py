import random

import numpy as np
import xxhash
from corpus_fixture import CLASH, frame, rows
from eventide.llm import simhash


def fingerprint(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(fps, distance=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def near_rows(seed=5):
    rng, out = random.Random(seed), []
    for i in range(40):
        t = " ".join(f"w{rng.randint(0, 400)}" for _ in range(120)).split()
        for k in range(rng.choice((1, 1, 2, 5))):
            u = list(t)
            for _ in range(k):
                u[rng.randrange(len(u))] = "changed"
            out.append((1000 - len(out), " ".join(u), "en", "s", 0))
    return out


def test_fingerprints_of_odd_texts():
    texts = [t for _, t, *_ in rows()] + ["One", "one TWO", "a b c", "a b c d", "a b c d " * 100]
    assert simhash.fingerprints_of(texts).tolist() == [fingerprint(t) for t in texts]
    long = " ".join(f"t{i}" for i in range(simhash.SLICE + 500))
    assert simhash.fingerprints_of([long, "a"]).tolist() == [fingerprint(long), fingerprint("a")]


def test_components_against_brute_force(spark):
    data = rows() + near_rows()
    got = simhash.simhash_query(frame(spark, data)).collect()
    assert len(got) == len(data)
    fps = [fingerprint(t) for _, t, *_ in data]
    root = groups(fps)
    least = {}
    for r, (d, *_) in zip(root, data):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    exp = sorted((str(d), f"{f:016x}", least.get(r)) for r, f, (d, *_) in zip(root, fps, data))
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == exp
    assert len(set(root)) < len(set(fps))  # some link joins different texts


def test_every_link_meets_in_a_leaf():
    rng = np.random.default_rng(3)
    f = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in f], np.uint64)
    g = f ^ flips
    every = np.unique(np.concatenate([f, g]))
    met = np.zeros(len(f), bool)
    for mask in simhash.part_masks():
        tree = simhash.build_tree(every[::2], mask, simhash.DISTANCE // simhash.PARTS)
        pa, la = simhash.route(tree, f)
        pb, lb = simhash.route(tree, g)
        b = set(zip(pb.tolist(), lb.tolist()))
        for x in zip(pa.tolist(), la.tolist()):
            met[x[0]] |= x in b
        assert len(la) < 30 * len(f)  # the triangle bounds prune
    assert met.all()


def test_dense_leaf_gives_a_spanning_set():
    centre = 0x0123456789ABCDEF
    f = np.unique(np.array([centre ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)], np.uint64))
    a, b = simhash.spanning_links(f)
    assert len(a) == len(f) - 1 and (simhash._roots(len(f), a, b) == 0).all()


def test_large_leaf_is_cut_into_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF_ROWS", 8)
    test_components_against_brute_force(spark)


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(900, 901)], "a long, b long")
    got = {r["v"]: r["root"] for r in simhash.component_roots(links).collect()}
    assert {got[i] for i in range(1, 201)} == {got[1]} and got[900] == got[901] != got[1]


def test_keep_one(spark):
    data = rows() + near_rows()
    df = frame(spark, data, clash=True)
    got = simhash.keep_one(df)
    assert got.columns == df.columns and got.select(*CLASH).distinct().count() == 1
    kept = got.collect()
    root = groups([fingerprint(t) for _, t, *_ in data])
    least = {}
    for r, (d, *_) in zip(root, data):
        least[r] = min((d is None, d or 0), least.get(r, (True, 0)))
    assert len(kept) == len(set(root))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept) == sorted(least.values())


def test_empty_table(spark):
    assert simhash.simhash_query(frame(spark, [])).collect() == []
    assert simhash.keep_one(frame(spark, [])).collect() == []


def test_sample_is_bounded_and_spread(spark):
    rng = np.random.default_rng(4)
    f = np.unique(rng.integers(-(1 << 62), 1 << 62, 20_000))
    df = spark.createDataFrame([(int(x),) for x in f], "fp long")
    got = simhash.bounded_sample(df, "fp", len(f), size=2_000)
    assert 1_700 < len(got) < 2_300 and np.isin(got.view(np.int64), f).all()
    assert 0.4 < (got.view(np.int64) < 0).mean() < 0.6
    assert len(simhash.bounded_sample(df, "fp", len(f), size=20_000)) == len(f)
