from collections import Counter
import hashlib

import pytest
from corpus_fixture import SCHEMA, frame, rows

from eventide.llm.token_alignment import alignment_query, tokenizer_paths

ODD = [(200, "a  b\n\n c <s> </s> <unk> <0x41> <|endoftext|> d", "en", "s", 1), (201, "trailing ", "en", "s", 1),
       (202, " lead", "en", "s", 1), (203, " ", "en", "s", 1), (204, "▁x holds the sign", "en", "s", 1),
       (205, "日本語のテキスト と 空白　   x  y", "ja", "s", 1), (206, "\n", "en", "s", 1),
       (207, "naïve café — “quoted” … I'll we've\t tab \r\n end.", "en", "s", 1), (208, "🙂🙃 👩‍👩‍👧 é x", "en", "s", 1)]


def _brute(data):
    import sentencepiece
    from tokenizers import Tokenizer
    a_path, b_path = tokenizer_paths()
    a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {chr(x): x for x in visible}
    sign |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in visible)}

    def b_piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    links, said, out = [], [], []
    for _, text, *_ in data:
        ta, tb = a.encode(" " + text, add_special_tokens=False) if text else None, b.encode(text) if text else []
        pa = [bytes(sign[c] for c in t) for t in ta.tokens] if text else []
        pb = [b_piece(i) for i in tb]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(pa) != whole or b"".join(pb) != whole:
            links.append([])
            said.append(None)
            continue
        sides = []
        for ids, parts in ((ta.ids, pa), (tb, pb)):
            at, got = 0, []
            for i, p in zip(ids, parts):
                got.append((at, at + len(p), i))
                at += len(p)
            sides.append(got)
        ends = sorted({e for _, e, _ in sides[0]} & {e for _, e, _ in sides[1]})
        groups, lo = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for s, _, i in side if lo <= s < e) for side in sides))
            lo = e
        found, start = [], 0
        for s, e, i in sides[0]:
            while start < len(sides[1]) and sides[1][start][1] <= s:
                start += 1
            k = start
            while k < len(sides[1]) and sides[1][k][0] < e:
                found.append((i, sides[1][k][2]))
                k += 1
        links.append(found)
        said.append((len(sides[0]), len(sides[1]), len(groups), ";".join(groups)))
    count = Counter(p for found in links for p in set(found))
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    for (doc, *_), found, s in zip(data, links, said):
        n = s or (0, 0, 0, "")
        out.append((doc, n[0], n[1], n[2], len(found), sum(count[p] == best[p[0]] for p in found), sum(count[p] for p in found),
                    hashlib.sha256(n[3].encode()).hexdigest() if s else ""))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("clash", [False, True])
def test_equals_whole_text_alignment(spark, clash):
    short = [r for r in rows() if not r[1] or len(r[1]) < 20_000] + [(105, "word " * 4_000, "en", "s1", 1), (106, "x" * 3_000, "en", "s", 1)]
    data = short + ODD
    got = alignment_query(frame(spark, data, clash))
    assert got.columns[0] == "doc_id" and set(got.columns) == set(COLUMNS)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr) == _brute(data)


def test_long_and_small_blocks(spark, monkeypatch):
    import eventide.llm.token_alignment as m
    monkeypatch.setattr(m, "SLICE_BYTES", 2_000)
    monkeypatch.setattr(m, "CACHE_UNITS", 50)
    data = [(i, f"one more text {i % 7} of {i} words", "en", "s", 1) for i in range(300)] + ODD
    got = alignment_query(frame(spark, data))
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr) == _brute(data)


def test_very_long_texts_and_empty_table(spark):
    got = {r.doc_id: r for r in alignment_query(frame(spark, [(1, "x" * 1_000_000, "en", "s", 1), (2, "a b " * 200_000, "en", "s", 1),
                                                              (3, None, None, None, None)])).collect()}
    assert got[1].n_a > 0 and got[2].n_links >= 400_000 and got[3].groups_sha256 == ""
    assert alignment_query(spark.createDataFrame([], SCHEMA)).collect() == []


def test_text_ids(spark):
    df = spark.createDataFrame([("k1", "some text"), (None, "some text")], "doc_id string, text string")
    assert {r.doc_id: r.count_sum for r in alignment_query(df).collect()} == {"k1": 4, None: 4}
