import random
import re
import sre_parse

import duckdb
import pytest
from corpus_fixture import SCHEMA, frame, rows

from eventide.llm.license_rules import rules
from eventide.llm.license_scan import BASE, detections, keywords, licenses, oracle, over_words, signatures

NOTICES = [
    (300, "Licensed under the Apache License, Version 2.0 (the \"License\");\n you may not use this file except in compliance with the License.", "en", "s", 1),
    (301, "GNU Lesser General Public License v2.1, GNU General Public License, version 3", "en", "s", 1),
    (302, "// SPDX-License-Identifier: GPL-3.0-only\n MIT License MIT license\tmit-LICENSE", "en", "s", 1),
    (303, "CC BY-NC-SA 4.0 and Creative Commons Attribution-NonCommercial 4.0 International License", "en", "s", 1),
    (304, "permitlicense mit licenses apachelicense general public", "en", "s", 1),
    (305, "émit license mİt license mit license", "en", "s", 1),
    (306, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
          "All rights reserved. Apache License 2.0; BSD 3-Clause License", "en", "s", 1),
    (307, "mit license " * 3_000, "en", "s", 1)]


def _brute(data):
    known = signatures()
    out = []
    for doc, text, *_ in data:
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        t = " " + "  ".join(ws) + " "
        found = [(t[:m.start()].count(" ") // 2, t[:m.end()].count(" ") // 2, s["tier"], s["ord"], s["label"])
                 for s in known for m in re.finditer(s["pattern"], t)]
        base = [f for f in found if f[2] == 4]
        mine = [f for f in found if f[2] < 4]
        alone = [f for f in mine if not any(o[0] <= f[0] and o[1] >= f[1] and (o[1] - o[0] > f[1] - f[0] or o[3] < f[3]) for o in mine if o is not f)]
        kept = [f for f in alone if not any(o[2] < f[2] and o[0] < f[1] and o[1] > f[0] for o in alone)]
        strength = {1: 1.0, 2: 0.8, 3: 0.5, 4: 0.4}
        out.append((doc, len(ws), len(base), min((f[0] for f in base), default=None), max((f[0] for f in base), default=None),
                    ",".join(sorted({f[4] for f in base})), ",".join(sorted({f[4] for f in base + kept})),
                    max((strength[f[2]] for f in base + kept), default=0.0)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("clash", [False, True])
def test_equals_brute_force(spark, clash):
    data = rows() + NOTICES[:-1]
    got = licenses(frame(spark, data, clash))
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _brute(data)


def test_equals_twin(spark):
    data = rows() + NOTICES
    got = licenses(frame(spark, data))
    docs = frame(spark, data).toPandas()  # noqa: F841 - read by the twin
    con = duckdb.connect()
    con.register("documents", docs)
    want = con.execute(oracle()).fetchall()
    names = [c[0] for c in con.description]
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_labels_of_notices(spark):
    got = {r.doc_id: r for r in licenses(frame(spark, NOTICES)).collect()}
    assert got[300].labels == "apache,apache-2.0" and got[300].score == 1.0
    assert got[301].labels == "gpl,gpl-3.0,lgpl-2.1" and got[301].n_base == 2
    assert got[302].labels == "gpl-3.0,mit" and got[302].n_base == 3
    assert got[303].labels == "cc-by-nc,cc-by-nc-sa"
    assert got[304].n_base == 0 and (got[305].n_base, got[305].first_word) == (1, 4)
    assert got[307].n_base == 3_000 and got[307].last_word == 5_998


def _sample(rng, parsed):
    out = ""
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "SUBPATTERN":
            out += _sample(rng, arg[3])
        elif name == "BRANCH":
            out += _sample(rng, rng.choice(arg[1]))
        elif name == "MAX_REPEAT":
            out += "".join(_sample(rng, arg[2]) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 1))))
        elif name == "NOT_LITERAL":
            out += "w"
        elif name == "IN":
            negated = str(arg[0][0]) == "NEGATE"
            out += "w" if negated else chr(rng.choice([x for k, v in arg for x in ([v] if str(k) == "LITERAL" else range(v[0], v[1] + 1))]))
        else:
            raise AssertionError(name)
    return out


def test_every_rule_is_reachable_through_its_gates():
    rng = random.Random(3)
    assert len(rules()) > 200
    for label, tier, keyword, expression in rules():
        assert label and tier in (1, 2, 3)
        pattern = over_words(expression)
        for _ in range(20):
            text = _sample(rng, sre_parse.parse(pattern))
            assert re.fullmatch(pattern, text), (expression, text)
            for gate in keywords(keyword, expression):
                assert gate in text, (gate, expression, text)
    assert all(keywords(p.split()[0], p)[0] == "licen" for p in BASE)


def test_containment_and_priority(spark):
    text = "zero released under the mit license and all rights reserved"
    got = {(r.label, r.tier, r.start, r.end): r.kept for r in detections(frame(spark, [(1, text, "en", "s", 1)])).collect()}
    assert got[("mit", 2, 1, 6)] and not got[("mit", 3, 4, 6)] and got[("proprietary", 2, 7, 10)]


def test_long_texts_and_empty_table(spark):
    got = {r.doc_id: r for r in licenses(frame(spark, [(1, "license " * 125_000, "en", "s", 1), (2, "x" * 1_000_000 + " mit license", "en", "s", 1),
                                                       (3, "mit license " * 80_000, "en", "s", 1)])).collect()}
    assert got[1].n_base == 0 and got[2].first_word == 1 and got[3].n_base == 80_000
    assert licenses(spark.createDataFrame([], SCHEMA)).collect() == []
