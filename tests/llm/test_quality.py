import random

import numpy as np
import pytest
from corpus_fixture import CLASH, frame, labels, rows, words
from eventide.llm import common, quality


def corpus(n=600, seed=6):
    rng, data, lab = random.Random(seed), [], []
    for i in range(n):
        t, bad = words(rng, rng.randint(20, 90)), i % 6 == 0
        if bad:
            t = rng.choice((lambda x: " ".join(w + "!!" for w in x.upper().split()),
                            lambda x: " ".join(w for w in x.split()[:6] for _ in range(9)),
                            lambda x: " | ".join(x.split())))(t)
        data.append((i, t, "xx", "s", 0))
        lab.append((i, int(not bad), 0))
    return data, lab


def test_held_out_accuracy_and_determinism(spark):
    data, lab = corpus()
    got = quality.quality_query(frame(spark, data), labels(spark, lab)).collect()
    truth = {i: q for i, q, _ in lab}
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(data) and sum(r["predicted"] != truth[r["doc_id"]] for r in held) <= 0.03 * len(held)
    again = quality.quality_query(frame(spark, data).repartition(5), labels(spark, lab)).collect()
    assert {r["doc_id"]: round(r["score"], 6) for r in got} == {r["doc_id"]: round(r["score"], 6) for r in again}


def test_word_vectors_against_plain_loops(spark):
    texts = ["a b c a", "b, b!", None, "", "c a"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = quality.word_vectors(df)
    places, signs = quality.index_vectors()
    total = np.zeros((quality.BUCKETS, quality.DIM))
    for t in texts:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        b, _, _ = quality.tokens(raw, np.array([0, len(raw)]))
        for i in range(len(b)):
            for j in range(max(0, i - quality.WINDOW), min(len(b), i + quality.WINDOW + 1)):
                if i != j:
                    np.add.at(total[b[i]], places[b[j]], signs)
    exp = np.sign(total) * np.sqrt(np.abs(total))
    exp -= exp[exp.any(axis=1)].mean(axis=0)
    norm = np.sqrt((exp * exp).sum(1))
    exp[norm > 0] /= norm[norm > 0, None]
    assert np.allclose(got, exp, atol=1e-6)


def test_long_text_in_pieces_pools_like_the_whole(monkeypatch):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((quality.BUCKETS, quality.DIM)).astype(np.float32)
    vectors /= np.sqrt((vectors ** 2).sum(1))[:, None]
    raw = np.frombuffer((words(random.Random(1), 4000)).encode(), np.uint8)
    whole = quality.pooled(raw, np.array([0, len(raw)]), vectors)
    monkeypatch.setattr(quality, "POOL_BYTES", 1000)
    assert len(common.segments(raw, np.array([0, len(raw)]), 1000)[1]) > 10
    assert np.allclose(whole, quality.pooled(raw, np.array([0, len(raw)]), vectors), atol=0.01)


def test_odd_rows(spark):
    data, lab = corpus(120)
    df = frame(spark, rows(), clash=True)
    model = quality.fit_quality(frame(spark, data), labels(spark, lab + [(0, None, 1), (1, 0, 0), (None, 1, 1)]))
    got = quality.score_quality(df, model)
    assert set(df.columns) <= set(got.columns) and got.count() == len(rows())
    assert got.select(*[c for c in CLASH if c not in ("score", "predicted")]).distinct().count() == 1
    r = got.select("doc_id", "text", "score").collect()
    assert len({x["score"] for x in r if not x["text"]}) == 1 and all(0 <= x["score"] <= 1 for x in r)
    one = quality.quality_query(frame(spark), labels(spark, [(1, 1, 0)])).collect()
    assert {x["score"] for x in one} <= {1.0, 0.5}
    assert quality.quality_query(frame(spark, []), labels(spark, [])).collect() == []


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, quality.FEATURES))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = quality.train(x, y)
    fresh = rng.standard_normal((4000, quality.FEATURES))
    p = 1 / (1 + np.exp(-quality._forward(net, fresh) / net["temperature"]))
    truth = (rng.random(4000) < 1 / (1 + np.exp(-2 * fresh[:, 0]))).astype(float)
    loss = -np.mean(truth * np.log(p + 1e-9) + (1 - truth) * np.log(1 - p + 1e-9))
    assert net["temperature"] > 0 and loss == pytest.approx(0.42, abs=0.15)
