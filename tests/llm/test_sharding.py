import zlib
from collections import Counter, defaultdict

from corpus_fixture import frame, rows
from eventide.llm import sharding


def check(spark, data):
    got = sharding.sharding_query(frame(spark, data)).collect()
    exp = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in data)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == exp
    slots, load = defaultdict(list), Counter()
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < sharding.SHARDS
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return got, [load[s] for s in range(sharding.SHARDS)]


def test_odd_rows(spark):
    check(spark, rows())


def test_even_sizes_and_whole_groups(spark):
    data = [(i, f"text {i} " + "x" * (i * 37 % 900), None, None, 0) for i in range(3000)]
    data += [(5000 + i, f"copy {i // 4} " + "y" * 300, None, None, 0) for i in range(400)]
    got, load = check(spark, data)
    assert max(load) < 1.01 * sum(load) / len(load) and min(load) > 0.99 * sum(load) / len(load)
    where = defaultdict(set)
    for r in got:
        if r["doc_id"] >= 5000:
            where[(r["doc_id"] - 5000) // 4].add(r["shard"])
    assert sum(len(s) == 1 for s in where.values()) >= 95


def test_group_larger_than_a_shard_is_split_evenly(spark):
    data = [(i, "the same text again", None, None, 0) for i in range(2400)]
    _, load = check(spark, data)
    assert max(load) - min(load) <= 2 * 27
    data += [(9000 + i, f"single {i}", None, None, 0) for i in range(4000)]
    got, load = check(spark, data)
    assert max(load) - min(load) <= 100
    used = Counter(r["shard"] for r in got if r["doc_id"] < 9000)
    assert len(used) < sharding.SHARDS  # the group gathers where there is room


def test_mostly_small_groups_stay_whole_and_even(spark):
    for size, linked in ((2, 1.0), (3, 0.8)):
        n = int(4800 * linked) // size
        data = [(i, f"copy {i // size} " + "y" * 60, None, None, 0) for i in range(n * size)]
        data += [(9000 + i, f"single {i} " + "y" * 60, None, None, 0) for i in range(4800 - n * size)]
        got, load = check(spark, data)
        assert max(load) < 1.02 * sum(load) / len(load) and min(load) > 0.98 * sum(load) / len(load)
        where = defaultdict(set)
        for r in got:
            if r["doc_id"] < 9000:
                where[r["doc_id"] // size].add(r["shard"])
        assert len(where) == n and sum(len(s) > 1 for s in where.values()) < sharding.SHARDS


def test_levels():
    assert sharding._levels([0, 0, 0], 9) == [3, 3, 3]
    assert sharding._levels([5, 0, 1], 3) == [0, 2, 1]
    assert sharding._levels([1, 1], 0) == [0, 0]


def test_empty_table(spark):
    assert sharding.sharding_query(frame(spark, [])).collect() == []
