"""Secret scan: three base patterns and sliding-window entropy.

Base patterns, leftmost and non-overlapping each: key assignments, access keys
and long hexadecimal strings.  The method adds spans: candidate strings (runs
of ``ENTROPY_CHARS`` with a digit) are read by a window of ``WINDOW``
characters that moves one character at a time; it keeps the counts of its
characters (small counters packed in six longs) and the sum of c * log2(c),
adding the character that enters and taking away the one that leaves, so each
step costs the same and a candidate of any length takes time in proportion.  The largest
Shannon entropy of a window is held against the threshold of the candidate's
character class (digits and a-f, one letter case with digits, both cases with
digits, with signs).  An allow-list drops known harmless forms; candidates
that overlap a base span are dropped too, base spans always stay.

Only DataFrame functions: a text is split at its matches on the spot, after
that only the matches' lengths travel, and running sums of them give the
places in code points.  One document's matches are the largest group.

Defined results: a null text counts as empty and has no spans; rows are told
apart by an own number, so repeated rows are scanned each; null ids stay null;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KINDS = ("assign", "access", "hex")
# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_MIN = 6

ENTROPY_CHARS = "A-Za-z0-9+/_="
WINDOW = 20
CANDIDATE = rf"(?<![{ENTROPY_CHARS}])(?=[A-Za-z+/_=]*+[0-9])[{ENTROPY_CHARS}]{{{WINDOW},}}+"
#: Bits a window must reach, by character class.
THRESHOLDS = {"hex": 3.0, "single": 3.6, "mixed": 3.9, "signs": 3.9}
#: Candidates of these forms are harmless: what they match and, if given, may
#: not hold.  No group is repeated, so texts of any length are matched in a loop.
ALLOW = (
    (r"^[0-9_/=+]+$", None),                                      # numbers, dates, separators
    (r"^[A-Za-z][A-Za-z_/]*[0-9]{1,4}$", "[_/]{2}"),              # names with a short number
    (r"^[a-z]+://", None),                                        # addresses
    (r"(?i)example|placeholder|lorem|x{8,}|0{8,}|1234567", None),
)                                                                 # and one character repeated
#: A counter of a window's characters: 5 bits each, 12 in a long.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_="
BITS, IN_LONG = 32, 12
LONGS = -(-len(ALPHABET) // IN_LONG)
UNIT = 1 << 40      # c * log2(c) in whole numbers, so that sums do not drift


def _kind(name: str, text: Column, pattern: str, usable) -> Column:
    """Structs (kind, nth, gap, length, ok, body) of all matches of one kind."""
    # both lists are made once; the text behind the last match has none of its own
    pairs = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                       lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("m")))
    matches = F.transform(F.filter(pairs, lambda p: p["m"].isNotNull()), lambda p, i: F.struct(
        F.lit(name).alias("kind"), i.alias("nth"), p["gap"].alias("gap"), F.length(p["m"]).alias("length"),
        usable(p["m"]).alias("ok"), (p["m"] if name == "entropy" else F.lit("")).alias("body")))
    none = F.array().cast("array<struct<kind:string,nth:int,gap:int,length:int,ok:boolean,body:string>>")
    return F.when(text.rlike(pattern), matches).otherwise(none)


def window_entropy(body: Column, width: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of ``width`` neighbouring characters.

    One pass: the state holds the counters and the sum of c * log2(c); a step
    raises the counter of the character that enters and lowers that of the one
    that leaves, whatever the length of the text.
    """
    table = lambda values, kind: F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")
    place = {ord(c): i for i, c in enumerate(ALPHABET)}
    which = table([place.get(c, 0) // IN_LONG for c in range(128)], "int")
    one = table([BITS ** (place.get(c, 0) % IN_LONG) for c in range(128)], "bigint")
    xlog = table([round(c * math.log2(c) * UNIT) if c > 1 else 0 for c in range(BITS)], "bigint")
    codes = F.transform(F.split(body, "", -1), lambda c: F.ascii(c))
    # an empty last piece of the split is no character
    codes = F.slice(codes, 1, F.length(body))
    late = F.concat(F.array_repeat(F.lit(None).cast("int"), width), codes)
    steps = F.slice(F.zip_with(codes, late, lambda enters, leaves: F.struct(enters.alias("enters"), leaves.alias("leaves"))), 1, F.length(body))
    names = [f"c{k}" for k in range(LONGS)]
    zero = F.struct(*[F.lit(0).cast("bigint").alias(n) for n in names], F.lit(0).cast("bigint").alias("s"), F.lit(0).alias("n"),
                    F.lit(None).cast("bigint").alias("least"))

    def counted(counts: list[Column], char: Column) -> Column:
        word = F.element_at(F.array(*counts), F.element_at(which, char + 1) + 1)
        return (F.call_function("div", word, F.element_at(one, char + 1)) % BITS).cast("int")

    def moved(counts: list[Column], char: Column, by: int) -> list[Column]:
        change = F.element_at(one, char + 1) * by
        return [c + F.when(F.element_at(which, char + 1) == k, change).otherwise(0) for k, c in enumerate(counts)]

    def step(state, x):
        counts = [state[n] for n in names]
        out = counted(counts, x["leaves"])
        weight = lambda c: F.element_at(xlog, c + 1)
        same = x["leaves"] == x["enters"]
        now = counted(counts, x["enters"])
        gone = F.when(x["leaves"].isNull(), F.lit(0)).otherwise(weight(out) - weight(out - 1))
        left = [F.when(x["leaves"].isNull(), a).otherwise(b) for a, b in zip(counts, moved(counts, x["leaves"], -1))]
        base = now - F.when(F.coalesce(same, F.lit(False)), 1).otherwise(0)
        s = state["s"] - gone + weight(base + 1) - weight(base)
        n = state["n"] + 1
        return F.struct(*[c.alias(k) for k, c in zip(names, moved(left, x["enters"], 1))], s.alias("s"), n.alias("n"),
                        F.when(n >= width, F.least(state["least"], s)).otherwise(state["least"]).alias("least"))

    bits = lambda state: F.coalesce(F.lit(math.log2(width)) - state["least"] / F.lit(float(width * UNIT)), F.lit(0.0))
    return F.aggregate(steps, zero, step, bits)


def suspicious(body: Column) -> Column:
    """Whether a candidate passes its class's threshold and no allow-list form."""
    lower, upper, sign = body.rlike("[a-z]"), body.rlike("[A-Z]"), body.rlike("[+/_=]")
    least = (F.when(body.rlike("^[0-9a-f]+$"), THRESHOLDS["hex"]).when(sign, THRESHOLDS["signs"])
             .when(lower & upper, THRESHOLDS["mixed"]).otherwise(THRESHOLDS["single"]))
    allowed = F.length(F.replace(body, F.substring(body, 1, 1), F.lit(""))) == 0
    for form, but in ALLOW:
        allowed = allowed | (body.rlike(form) & ~body.rlike(but) if but else body.rlike(form))
    return F.when(allowed, False).otherwise(window_entropy(body) >= least)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, spans): ``spans`` sorted structs (start, order, kind, end)."""
    t = F.coalesce(F.col(text), F.lit(""))
    yes = lambda m: F.lit(True)
    long_enough = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_MIN
    found = F.concat(_kind("assign", t, ASSIGN, long_enough), _kind("access", t, ACCESS, yes), _kind("hex", t, HEX, yes),
                     _kind("entropy", t, CANDIDATE, yes))
    rows = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), found.alias("found"))
            .select("row", "doc_id", F.explode_outer("found").alias("m")).select("row", "doc_id", "m.*"))
    along = Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(along))
              .withColumn("start", F.col("end") - F.col("length")))
    base = F.col("kind").isin(*KINDS) & F.col("ok")  # a dropped match only took up its place
    # both ways from the group's ends: a frame to its other end would be computed anew for each row
    order = ["start", "end", "kind", "nth"]
    upto = lambda by: Window.partitionBy("row").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    reached = F.max(F.when(base, F.col("end"))).over(upto(order))
    ahead = F.min(F.when(base, F.col("start"))).over(upto([F.desc(c) for c in order]))
    alone = F.coalesce(reached <= F.col("start"), F.lit(True)) & F.coalesce(ahead >= F.col("end"), F.lit(True))
    kept = (placed.withColumn("alone", alone)
            .withColumn("keep", F.when(F.col("kind").isNull() | ~F.col("ok"), False).when(base, True)
                        .when(~F.col("alone"), False).otherwise(suspicious(F.col("body")))))
    rank = F.array_position(F.array(*[F.lit(k) for k in (*KINDS, "entropy")]), F.col("kind"))
    return (kept.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.sort_array(F.collect_list(F.when(F.col("keep"), F.struct("start", rank.alias("order"), "kind", "end")))).alias("spans")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets_query(docs: DataFrame) -> DataFrame:
    spans = F.col("spans")
    n = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return scan_secrets(docs).select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(_joined(F.filter(spans, lambda s: s["kind"] != "entropy")).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"))


def _oracle_kind(name: str, order: int, pattern: str, ok: str) -> str:
    p = pattern.replace("'", "''")
    return f"""
  SELECT row, doc_id, '{name}' AS kind, {order} AS ord, i, m, {ok} AS ok,
         CAST(sum(length(gap) + length(m)) OVER (PARTITION BY row ORDER BY i) AS BIGINT) AS stop
  FROM (SELECT row, doc_id, unnest(range(len(ms))) AS i, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap
        FROM (SELECT row, doc_id, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS gaps FROM d))"""


def oracle() -> str:
    """The same result in DuckDB: window entropies from plain counts."""
    allowed = " OR ".join(f"regexp_matches(m, '{a}')" + (f" AND NOT regexp_matches(m, '{b}')" if b else "") for a, b in ALLOW)
    run = f"[{ENTROPY_CHARS}]{{{WINDOW},}}"
    assign = ASSIGN.replace("'", "''")
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
a AS ({_oracle_kind("assign", 1, ASSIGN, f"length(regexp_extract(m, '{assign}', 2)) >= {ASSIGN_MIN}")}
  UNION ALL {_oracle_kind("access", 2, ACCESS, "true")}
  UNION ALL {_oracle_kind("hex", 3, HEX, "true")}),
b AS (SELECT *, stop - length(m) AS start FROM a WHERE ok),
c AS (SELECT *, stop - length(m) AS start FROM ({_oracle_kind("entropy", 4, run, "regexp_matches(m, '[0-9]')")}
  ) WHERE ok AND NOT ({allowed}) AND len(list_distinct(string_split(m, ''))) > 1),
e AS (
  SELECT row, i, max(bits) AS bits FROM (
    SELECT row, i, w, sum(-n / {WINDOW}.0 * log2(n / {WINDOW}.0)) AS bits FROM (
      SELECT row, i, w, substr(m, CAST(w + k + 1 AS BIGINT), 1) AS ch, count(*) AS n
      FROM (SELECT row, i, m, unnest(range(length(m) - {WINDOW} + 1)) AS w FROM c), range({WINDOW}) r(k) GROUP BY ALL)
    GROUP BY ALL) GROUP BY ALL),
f AS (
  SELECT c.* FROM c JOIN e ON c.row = e.row AND c.i = e.i
  WHERE e.bits >= CASE WHEN regexp_full_match(m, '[0-9a-f]+') THEN {THRESHOLDS["hex"]} WHEN regexp_matches(m, '[+/_=]') THEN {THRESHOLDS["signs"]}
                       WHEN regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') THEN {THRESHOLDS["mixed"]} ELSE {THRESHOLDS["single"]} END
    AND NOT EXISTS (SELECT 1 FROM b WHERE b.row = c.row AND b.start < c.stop AND b.stop > c.start)),
s AS (SELECT row, kind, ord, start, kind || ':' || start || ':' || stop AS span FROM b
      UNION ALL SELECT row, kind, ord, start, kind || ':' || start || ':' || stop FROM f),
g AS (
  SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         coalesce(string_agg(span, ',' ORDER BY start, ord) FILTER (kind <> 'entropy'), '') AS base,
         string_agg(span, ',' ORDER BY start, ord) AS spans FROM s GROUP BY row)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.row = g.row"""
