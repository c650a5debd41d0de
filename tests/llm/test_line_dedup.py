from corpus_fixture import CLASH, frame, rows
from eventide.llm.line_dedup import dedup_lines


def brute(data):
    """doc texts after dedup; rows repeating an id with an equal text count as one."""
    first, gone = {}, {}
    order = sorted({(d is not None, d or 0, t) for d, t, *_ in data if t is not None})
    for has, d, t in order:
        lines = [x.strip(" \t\r") for x in t.split("\n")]
        for i in range(len(lines) - 2):
            w = tuple(lines[i:i + 3])
            if any(w):
                first[w] = min(first.get(w, (has, d, i, t)), (has, d, i, t))
    for has, d, t in order:
        lines = [x.strip(" \t\r") for x in t.split("\n")]
        cover = set()
        for i in range(len(lines) - 2):
            w = tuple(lines[i:i + 3])
            if any(w) and first[w] != (has, d, i, t):
                cover |= {i, i + 1, i + 2}
        gone[(has, d, t)] = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in cover)
    return gone


def check(spark, data):
    gone = brute(data)
    got = dedup_lines(frame(spark, data)).collect()
    assert len(got) == len(data)
    exp = sorted((str(d), "" if t is None else gone[(d is not None, d or 0, t)]) for d, t, *_ in data)
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in got) == exp
    return gone


def test_against_brute_force(spark):
    check(spark, rows())


def test_shared_passages_blank_windows_and_overlaps(spark):
    p = "one two three\nfour five\n six seven \t"
    data = [(1, f"a\n{p}\nb", None, "x", 1), (2, f"{p}\nc\nd\ne", None, "x", 1), (3, f"q\n{p}\n{p}", None, "x", 1),
            (4, "s\ns\ns\ns\ns\ns", None, "x", 1), (5, "\n\n\n\n\n", None, "x", 1), (6, "\n\n\n\n", None, "x", 1),
            (7, "k\nl\nm\nn\no", None, "x", 1), (8, "l\nm\nn\no\np", None, "x", 1), (9, "two\nlines", None, "x", 1),
            (10, "two\nlines", None, "x", 1), (None, f"{p}\nnull id", None, "x", 1)]
    gone = check(spark, data)
    assert gone[(True, 2, data[1][1])] == "c\nd\ne" and gone[(True, 4, data[3][1])] == "s"
    assert gone[(True, 5, data[4][1])] == data[4][1] and gone[(True, 8, data[7][1])] == "p"


def test_long_passages_of_one_and_two_lines(spark):
    from eventide.llm import stages
    p, a, b = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("p", 55), ("a", 30), ("b", 30)))
    texts = {1: f"x\n{p}\ny", 2: f"u\n {p}\t\nv", 3: p, 4: f"k\n{a}\n{b}\nl", 5: f"m\n{a}\n{b}\nn", 6: f"o\n{a}\nq"}
    got = {r["doc_id"]: r["text"] for r in stages.line_dedup(spark, frame(spark, [(i, t, None, None, 0) for i, t in texts.items()]), "").collect()}
    assert got == texts | {2: "u\nv", 3: "", 5: "m\nn"}


def test_columns_and_report(spark):
    df = frame(spark, clash=True)
    got = dedup_lines(df)
    assert got.columns == df.columns and got.select(*CLASH).distinct().count() == 1
    r = dedup_lines(frame(spark, [(1, "a\nb\nc\nd", None, None, 0), (2, "x\na\nb\nc", None, None, 0), (3, None, None, None, 0)])
                    .select("doc_id", "text"), report=True).orderBy("doc_id").collect()
    assert [tuple(x) for x in r] == [(1, "a\nb\nc\nd", 4, 0), (2, "x", 4, 3), (3, None, 0, 0)]


def test_empty_table(spark):
    assert dedup_lines(frame(spark, [])).collect() == []
