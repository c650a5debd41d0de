import hashlib

import numpy as np
from corpus_fixture import frame, rows
from eventide.llm import fingerprints as fp
from pyspark.sql import functions as F


def check(spark, data):
    got = fp.fingerprint_documents(frame(spark, data)).collect()
    assert len(got) == len(data)
    key = {t: spark.range(1).select(F.xxhash64(F.lit(t))).first()[0] for t in {t or "" for _, t, *_ in data} if len(t) < 1000}
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, key.get(r[1] or "", 0)))
    texts = [r[1] or "" for r in order]
    exp = []
    for k, (d, *_) in enumerate(order):
        a, b = texts[k], texts[(k + 1) % len(texts)]
        e = fp.edited(a, b)
        x, y, z = fp.fingerprint([a])[0], fp.fingerprint([e])[0], fp.fingerprint([b])[0]
        exp.append((str(d), len(a), hashlib.sha256(e.encode()).hexdigest(), fp.as_text(x), fp.as_text(y),
                    fp.likeness(x, y), fp.likeness(x, z)))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(exp)


def test_odd_rows(spark):
    check(spark, rows())


def test_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_ROWS", 7)
    monkeypatch.setattr(fp, "SLICE_BYTES", 300)
    check(spark, rows())
    check(spark, [(i * 10, f"text number {i} " * 9, None, None, 0) for i in range(100)])


def test_one_document_and_none(spark):
    check(spark, [(5, "only one text", None, None, 0)])
    assert fp.fingerprint_documents(frame(spark, [])).collect() == []


def test_gear_hash_against_its_sum():
    raw = np.random.default_rng(1).integers(0, 256, 500).astype(np.uint8)
    gear, h = fp._gear().astype(object), fp.gear_hashes(raw)
    for i in (0, 1, 31, 32, 499):
        exp = sum(int(gear[raw[i - j]]) << j for j in range(min(fp.REACH, i + 1))) % (1 << 32)
        assert int(h[i]) == exp


def test_chunks_depend_on_the_text_alone_and_resist_shifts():
    rng = np.random.default_rng(2)
    text = " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(3000))
    a = fp.fingerprint([text])[0]
    b = fp.fingerprint(["other", text, text + "x"])[1]
    assert (a == b).all()
    moved = fp.fingerprint(["some words before " + text])[0]
    assert fp.likeness(a, moved) > 0.98
    half = fp.fingerprint([text[:len(text) // 2]])[0]
    assert fp.likeness(a, half) > 0.98  # contained
    assert fp.likeness(a, fp.fingerprint([text[::-1]])[0]) < 0.02
    for c in fp.fingerprint([text]):
        sizes = c & np.uint64(0xFFFF)
        assert sizes.max() <= fp.MOST


def test_empty_fingerprints():
    e, x = fp.fingerprint(["", "abc"])
    assert fp.likeness(e, e) == 1 and fp.likeness(e, x) == 0 and fp.as_text(e) == ""


def _plain_chunks(text: bytes) -> list[bytes]:
    """Byte by byte: the gear hash of the bytes so far, and a cut where its bits fit."""
    from eventide.llm import fingerprints as m
    gear, out, start = [int(x) for x in m._gear()], [], 0
    while len(text) - start > m.LEAST:
        stop = None
        for end in range(start + m.LEAST, len(text) + 1):
            size = end - start
            if size >= m.MOST:
                stop = end
                break
            h = 0
            for b in text[max(0, end - m.REACH):end]:
                h = (h * 2 + gear[b]) % (1 << 32)
            if h & m.LOOSE == 0 and (size >= m.NORMAL or h & m.STRICT == 0) and end < len(text):
                stop = end
                break
        if stop is None:
            break
        out.append(text[start:stop])
        start = stop
    return out + ([text[start:]] if start < len(text) else [])


def test_chunks_equal_a_plain_loop():
    import random

    import numpy as np
    from eventide.llm import fingerprints as m
    rng = random.Random(8)
    texts = [b"", b"short", b"x" * 3_000, bytes(rng.randrange(1, 256) for _ in range(4_000)),
             " ".join(rng.choice(["an", "be", "car", "dote", "e"]) for _ in range(900)).encode(), b"ab" * m.LEAST]
    for text, got in zip(texts, m.chunk_sets(texts)):
        chunks = set(_plain_chunks(text))
        assert len(got) == len(chunks)
        assert sorted((got & np.uint64(0xFFFF)).tolist()) == sorted(len(c) for c in chunks)
