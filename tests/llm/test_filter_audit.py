import re
from itertools import permutations
from math import factorial

import pytest
from corpus_fixture import SCHEMA, frame, labels, rows, words

from eventide.llm.filter_audit import audit_query, coalition_values, potentials

import random

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _brute(data, labelled):
    good = {d for d, q, _ in labelled if q == 1 and d is not None}
    toxic = {d for d, _, t in labelled if t == 1 and d is not None}
    docs = []
    for doc, text, lang, *_ in data:
        t = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)),
                 "E": doc is not None and any(o[0] is not None and o[0] < doc and (o[1] or "") == t for o in data)}
        docs.append((lang or "", {f for f, x in fails.items() if x}, doc in good, doc in toxic))
    out = []
    for part in sorted({d[0] for d in docs}):
        mine = [d for d in docs if d[0] == part]
        shapley, found = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                now = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(now)
                found.append((part, "".join(order), step, len(left), len(now), sum(f in d[1] for d in mine) - len(now),
                              sum(d[1] == {f} for d in mine), sum(d[2] for d in now), sum(d[3] for d in now)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in found]
    return sorted(out)


def _rng_docs():
    rng = random.Random(5)
    data = rows() + [(300 + i, " ".join(rng.choice([words(rng, 60), "A B C", "x y " * 40, "#", "rare one"]) for _ in range(rng.randint(1, 3))),
                      rng.choice(["en", "de", "", None]), "s", 1) for i in range(120)]
    data += [(500 + i, rng.choice(data)[1], rng.choice(["en", "de", None]), "s", 1) for i in range(80)]
    labelled = [(d[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in data for _ in range(rng.randint(0, 2))]
    return data, labelled + [(None, 1, 1), (9_999, 1, 1)]


@pytest.mark.parametrize("clash", [False, True])
def test_equals_walking_every_order(spark, clash):
    data, labelled = _rng_docs()
    got = audit_query(frame(spark, data, clash), labels(spark, labelled))
    assert got.columns == COLUMNS
    assert sorted(tuple(r) for r in got.collect()) == _brute(data, labelled)


def test_potentials_are_whole_and_sum_to_all(spark):
    v = [sum(1 << f for f in range(5) if s >> f & 1) + (7 if s == 31 else 0) for s in range(32)]
    df = spark.createDataFrame([("p", v)], "part string, `all` array<bigint>")
    p = potentials(df).first()["potential"]
    shares = [p[31] - p[31 ^ (1 << f)] for f in range(5)]
    assert sum(shares) == 60 * v[31]
    want = []
    for f in range(5):
        total = 0
        for order in permutations(range(5)):
            before = sum(1 << g for g in order[:order.index(f)])
            total += v[before | 1 << f] - v[before]
        want.append(total)
    assert [x * factorial(5) // 60 for x in shares] == want


def test_hot_text_and_empty_tables(spark):
    data = [(i, "the same text", ["en", "fr"][i % 2], "s", 1) for i in range(500)] + [(None, "the same text", "en", "s", 1)] * 3
    got = audit_query(frame(spark, data), labels(spark, [(0, 1, 0), (1, 1, 1)])).where("filter_order = 'EABCD' and step = 1")
    assert {r.part: (r.kept, r.removed, r.good_lost, r.toxic_lost) for r in got.collect()} == {"en": (4, 249, 0, 0), "fr": (0, 250, 1, 1)}
    assert audit_query(spark.createDataFrame([], SCHEMA), labels(spark, [])).collect() == []
    assert coalition_values(spark.createDataFrame([], "part string, mask int, good int, toxic int, n bigint")).collect() == []
