import zlib
from collections import defaultdict

import numpy as np
import pytest
from corpus_fixture import frame, rows
from eventide.llm import packing
from tokenizers import Tokenizer

ODD = ["don't we'll IT'S x'sabc !'s", "a<|endoftext|>b", "24be64439e3e é≠ Á J̌ İ ﬁ ½²", "....,,,;;; $$$%%% a_b-c",
       "tab\there\rcr nbsp em\u0085nel", "日本語 テキスト한국어", "\U0001f600\U0001f600!!́", "'", "''s 's", "9's 4'", "ŉ ǰ", "--<|endoftext|>é<|startoftext|> <|ENDOFTEXT|> <|endoftext|><|endoftext|>x <|endoftext", "|> <|endoftext |>"]


def test_ids_equal_the_tokenizers_own():
    t = Tokenizer.from_file(packing.tokenizer_path())
    own = packing.Tokens(packing.tokenizer_path())
    texts = [r[1] or "" for r in rows()] + ODD
    for _ in range(2):  # learned, then remembered
        data = [x.encode() for x in texts]
        ids, first = own.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *(len(x) for x in data)]))
        for k, x in enumerate(texts):
            assert ids[first[k]:first[k + 1]].tolist() == t.encode(x, add_special_tokens=False).ids, x


def check(spark, data):
    t = Tokenizer.from_file(packing.tokenizer_path())
    got = packing.pack(frame(spark, data)).collect()
    docs = sorted((len(i), str(d), [zlib.crc32(np.array(i, "<u4").tobytes())]) for d, x, *_ in data
                  for i in [t.encode(x or "", add_special_tokens=False).ids + [1]] if len(i) <= packing.LENGTH)
    small = sorted((r["length"], str(r["doc_id"]), [r["ids_crc32"]]) for r in got if r["doc_tokens"] <= packing.LENGTH)
    assert small == docs
    pieces, seq = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[(r["doc_id"], r["doc_tokens"])].append(r)
        seq[r["sequence_id"]].append(r)
    for d, x, *_ in data:
        ids = np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4")
        if len(ids) > packing.LENGTH:
            for r in pieces[(d, len(ids))]:
                assert zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
            assert sum(r["length"] for r in pieces[(d, len(ids))]) == len(ids)
    for rs in seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.LENGTH
    return got, seq


def test_round_trip_of_odd_rows(spark):
    check(spark, rows() + [(600 + i, x, None, None, 0) for i, x in enumerate(ODD)])


def test_little_padding(spark):
    rng = np.random.default_rng(3)
    data = [(i, "word " * int(n), "en", "s", 0) for i, n in enumerate(rng.integers(1, 3000, 600))]
    _, seq = check(spark, data)
    sizes = np.array([sum(r["length"] for r in rs) for rs in seq.values()])
    assert sizes.sum() >= 0.98 * packing.LENGTH * len(sizes)


@pytest.mark.parametrize("low, high", [(0, 1), (8, 9), (4, 40), (30, 90), (120, 300)])
def test_little_padding_of_short_documents(spark, low, high):
    rng = np.random.default_rng(4)
    data = [(i, "word " * int(n), "en", "s", 0) for i, n in enumerate(rng.integers(low, high, 12_000))]
    got = packing.pack(frame(spark, data)).groupBy("sequence_id").sum("length").collect()
    sizes = np.array([r[1] for r in got])
    assert sizes.max() <= packing.LENGTH and sizes.sum() >= 0.98 * packing.LENGTH * (len(sizes) - 1)


def test_plan_covers_each_item_once():
    rng = np.random.default_rng(5)
    for demand in ({}, {7: 1}, {256: 5, 1: 3}, {100: 1000}, {int(c): int(n) for c, n in zip(range(1, 256, 5), rng.integers(0, 400, 51))}):
        plan, sequences = packing.plan(demand)
        room, ranks = np.zeros(sequences, int), defaultdict(list)
        for c, low, high, base, each in plan:
            ranks[c] += list(range(low, high))
            for r in range(low, high):
                room[base + (r - low) // each] += c
        assert {c: sorted(r) for c, r in ranks.items()} == {c: list(range(n)) for c, n in demand.items() if n}
        assert (room <= packing.LENGTH // packing.UNIT).all() and (room > 0).all()
        assert sequences <= sum(c * n for c, n in demand.items()) / 256 * 1.3 + 2 or 100 in demand


def test_linear_program_meets_its_bound():
    sizes, demand = np.array([3, 5, 7]), np.array([30.0, 20.0, 10.0])
    columns, x = packing.solve_patterns(sizes, demand, 10, gap=0)
    assert (columns @ x >= demand - 1e-6).all()
    assert abs(x.sum() - (10 + 10 + 20 / 3)) < 1e-6  # 7 + 3, 5 + 5 and 3 + 3 + 3


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_BYTES", 500)
    check(spark, rows())


def test_empty_table(spark):
    assert packing.pack(frame(spark, [])).collect() == []
