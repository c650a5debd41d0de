import random
import re
from collections import defaultdict

import pytest
from corpus_fixture import CLASH, frame, rows
from eventide.llm import mixing


def size_of(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def expected_targets(data):
    size = defaultdict(int)
    for _, t, _, s, _ in data:
        size[s] += size_of(t)
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(size.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= 2 * size[s]]
        if not over:
            for s in open_:
                target[s] = left * weight[s] / total
            break
        for s in over:
            target[s] = 2.0 * size[s]
            open_.discard(s)
        left -= sum(target[s] for s in over)
    return size, target


def test_targets_sizes_and_copies(spark):
    data = rows()
    size, target = expected_targets(data)
    got = mixing.mixing_query(frame(spark, data)).collect()
    assert len(got) == len(data)
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] not in (None, 3, 4)}
    taken = defaultdict(int)
    for i, t, _, s, _ in data:
        if i in by_id:
            assert by_id[i]["size"] == size_of(t) and by_id[i]["source_size"] == size[s]
            assert by_id[i]["target"] == pytest.approx(target[s])
    for r in got:
        assert r["taken"] <= 2 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["target"]] += r["taken"]
    largest = max(size_of(t) for _, t, _, _, _ in data)
    for t, n in taken.items():
        assert abs(n - t) <= largest


def test_reruns_agree_whatever_the_layout(spark):
    key = lambda r: tuple((x is None, x) for x in r)
    a = mixing.mixing_query(frame(spark)).collect()
    b = mixing.mixing_query(frame(spark).repartition(7)).collect()
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_one_hot_source_comes_near_its_target(spark):
    data = [(i, "a b c d e", "en", "hot" if i % 3 else f"s{i % 7}", 9) for i in range(3000)]
    source, taken, target = {d: s for d, _, _, s, _ in data}, defaultdict(int), {}
    for r in mixing.mixing_query(frame(spark, data)).collect():
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - t) <= 5 for s, t in target.items())


def test_copies_keep_rows_and_columns(spark):
    df = frame(spark, clash=True)
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns
    assert got.select(*CLASH).distinct().count() == 1
    once = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mixing_query(df).collect() if r["size"] and r["doc_id"] not in (None, 3, 4)}
    many = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert all(many.get(i, 0) == n for i, n in once.items())


def test_empty_table(spark):
    assert mixing.mixing_query(frame(spark, [])).collect() == []
    assert mixing.mixed_documents(frame(spark, [])).collect() == []


def _plain(data):
    """Copies by plain Python: c by bisection, Pareto's ratio, the nearest prefix."""
    import hashlib

    def uniform(doc, text):
        own = f"{mixing.SEED}:{'' if doc is None else doc}:{hashlib.md5((text or '').encode()).hexdigest()}"
        return (int(hashlib.md5(own.encode()).hexdigest()[:12], 16) + 0.5) / (1 << 48)

    size, target = expected_targets(data)
    taken, odds = {}, {}
    for s in size:
        docs = [(d, size_of(t), uniform(d, t)) for d, t, _, source, _ in data if source == s]
        whole = min(2, int(target[s] // size[s])) if size[s] else 0
        left = target[s] - whole * size[s]
        low, high = 0.0, 1.0
        for _ in range(200):
            c = (low + high) / 2
            low, high = (c, high) if sum(min(1.0, c * x) * x for _, x, _ in docs) < left else (low, c)
        c = (low + high) / 2
        for d, x, u in docs:
            odds[d] = min(1.0, c * x)
            taken[d] = whole * x
        if left > 1e-6 and whole < 2:
            sure = [(d, x) for d, x, _ in docs if c * x >= 1 - 1e-12]
            room = left - sum(x for _, x in sure)
            for d, x in sure:
                taken[d] += x
            before = 0
            for _, d, x in sorted((u / (1 - u) / (c * x / (1 - c * x)), d, x) for d, x, u in docs if 0 < c * x < 1 - 1e-12):
                if 2 * before + x < 2 * room:
                    taken[d] += x
                before += x
    return taken, odds


def test_equals_plain_pareto_sampling(spark):
    rng = random.Random(9)
    data = [(i, "w " * rng.choice([0, 1, 3, 9, 40, 40, 200, rng.randint(1, 600)]), "en", rng.choice(["a", "a", "b", "c", "d", None]), 1)
            for i in range(1500)]
    want, odds = _plain(data)
    got = {r["doc_id"]: r["taken"] for r in mixing.mixing_query(frame(spark, data)).collect()}
    assert got == want
    assert len({round(p, 6) for p in odds.values()}) > 100 and any(p == 1.0 for p in odds.values())


def test_inclusion_rises_with_size(spark):
    rng = random.Random(10)
    data = [(i, "w " * rng.choice([10, 50]), "en", "a" if i % 4 else "b", 1) for i in range(8000)]
    got = mixing.mixing_query(frame(spark, data)).collect()
    target = {r["source_size"]: r["target"] / r["source_size"] for r in got}
    for source_size, t in target.items():
        extra = {x: [r["taken"] / x - int(t) for r in got if r["size"] == x and r["source_size"] == source_size] for x in (10, 50)}
        if 0.05 < t - int(t) < 0.8:
            share = {x: sum(e) / len(e) for x, e in extra.items()}
            assert 3.5 < share[50] / share[10] < 6.5 or share[50] > 0.9
