import random

from corpus_fixture import CLASH, frame, labels, rows, words
from eventide.llm import toxicity
from eventide.llm.toxicity import ToxicityModel, fold


def test_folding_keeps_lengths():
    assert fold("1D10T") == "idiot" and fold("ѕсum") == "scum" and fold("ｓｔｕｐｉｄ") == "stupid"
    assert fold("Trа$h") == "trash" and fold("Été") == "été" and len(fold("mor0n3")) == 6


def test_matches_exceptions_and_length():
    m = ToxicityModel(lexicon={"idiot": 3.0, "idiots": 4.0, "scum": 2.0}, exceptions=("pond scum",))
    assert [x[2] for x in m.match("An 1d10ts of IDIOT pond scum, scum; preidiot")] == ["idiots", "idiot", "scum"]
    assert m.match(None) == m.match("") == []
    assert [x[2] for x in ToxicityModel().match("c1own l0ser w0rth1ess 1oser")] == ["clown", "loser", "worthless", "loser"]
    assert m.score("idiot") > m.score("idiot " + "word " * 500) > m.score("word " * 500) == m.score("") == m.score(None)


def corpus(n=1200, seed=4):
    rng, data, lab = random.Random(seed), [], []
    for i in range(n):
        w, toxic = words(rng, rng.randint(30, 80)).split(), i % 8 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), "zwerk" + rng.choice(("", "el", "ung", "ta", "oso")))
        data.append((i, " ".join(w), "xx", "s", 0))
        lab.append((i, 1, int(toxic)))
    return data, lab


def test_learned_stem_finds_held_out_texts(spark):
    data, lab = corpus()
    got = toxicity.toxicity_query(frame(spark, data), labels(spark, lab)).collect()
    truth = {i: t for i, _, t in lab}
    assert len(got) == len(data) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert 0.2 * len(data) < len(held) < 0.3 * len(data)
    assert sum(r["predicted"] != truth[r["doc_id"]] for r in held) <= 2
    model = toxicity.fit_toxicity(frame(spark, data), labels(spark, lab))
    assert "zwer" in {k[:4] for k in model.lexicon}


def test_held_out_labels_are_not_used(spark):
    import zlib
    data, lab = corpus(400)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in lab]
    a = toxicity.fit_toxicity(frame(spark, data), labels(spark, lab))
    b = toxicity.fit_toxicity(frame(spark, data), labels(spark, flipped))
    assert a == b


def test_odd_rows_without_labels(spark):
    df = frame(spark, clash=True)
    got = toxicity.score_toxicity(df, ToxicityModel())
    assert set(df.columns) <= set(got.columns) and got.count() == len(rows())
    assert got.select(*[c for c in CLASH if c not in ("score", "predicted")]).distinct().count() == 1
    none = toxicity.toxicity_query(frame(spark), labels(spark, [])).collect()
    assert len(none) == len(rows()) and {r["predicted"] for r in none} == {0}
    assert toxicity.toxicity_query(frame(spark, []), labels(spark, [(1, 1, None)])).collect() == []


def _plain_matches(model, text):
    """Every place of every entry by plain search, then the same choice."""
    found, spared = set(), set()
    for t in {fold(text), fold(text.replace("1", "l"))}:
        for entry, weight in [*model.lexicon.items(), *((p, None) for p in model.exceptions)]:
            term, at = fold(entry), -1
            while (at := t.find(term, at + 1)) >= 0:
                if not (at and t[at - 1].isalpha()):
                    (spared if weight is None else found).add((at, at + len(term), term, weight))
    left = [m for m in found if not any(s <= m[0] and m[1] <= e for s, e, _, _ in spared)]
    longest = {}
    for m in left:
        if m[0] not in longest or m[1] > longest[m[0]][1]:
            longest[m[0]] = m
    return [longest[k] for k in sorted(longest)]


def test_matcher_equals_plain_search():
    rng = random.Random(6)
    model = ToxicityModel(lexicon={"idiot": 3.0, "idiots": 4.0, "scum": 2.0, "scumbag": 3.0, "loser": 1.0},
                          exceptions=("pond scum", "sore loser", "scum of the pond", "pond scum idiot"))
    parts = ["idiot", "1diot", "id1ots", "pond scum", "scum", "scumbag", "s0re l0ser", "loser", "1oser", "scum of the pond", "x", "pond", ",", "preidiot"]
    for _ in range(400):
        text = rng.choice([" ", "", "  "]).join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert model.match(text) == _plain_matches(model, text), text


def test_many_exceptions_take_linear_time():
    import time
    model = ToxicityModel(lexicon={"idiot": 3.0, "scum": 2.0}, exceptions=("pond scum",))
    t0 = time.perf_counter()
    assert len(model.match("pond scum idiot " * 40_000)) == 40_000
    assert time.perf_counter() - t0 < 5


def test_sample_is_bounded_in_rows(spark):
    from eventide.llm.common import labelled_sample
    data = [(i % 3, f"text {i}", "xx", "s", 0) for i in range(600)] + [(10 + i, "t", "xx", "s", 0) for i in range(50)]
    lab = labels(spark, [(i, 1, i % 2) for i in (0, 1, 2, *range(10, 60))])
    got = labelled_sample(frame(spark, data), lab, "toxic", "text", 20).collect()
    assert len(got) == len({r["doc_id"] for r in got}) == 20
    every = {r["doc_id"]: r["text"] for r in labelled_sample(frame(spark, data), lab, "toxic", "text", 1000).collect()}
    for i in set(every) & {0, 1, 2}:
        assert every[i] == min(t for d, t, *_ in data if d == i)
