"""License scan: ordered signature rules over the words of a text.

A text becomes its words, lower-cased in A-Z.  The rules (``license_rules``)
are regular expressions over words, in order of preference and in three tiers
(wording, notice, name).  A keyword prefilter gates them twice: a text without
any gate word is not normalised at all, and a rule runs only on texts that hold
its keywords.  Overlapping detections are resolved in two steps:

1. containment: of all detections those whose words lie within another's go;
   of equal intervals the earlier rule's stays;
2. priority: of two that still overlap, the one of the weaker tier goes.

The base phrases are counted and named whatever the rules find.

Only DataFrame functions: a rule's matches are found on the spot by splitting
the words at them, after that only word counts travel, and running sums give
the places.  Containment is a running maximum of interval ends, so a document
with many detections is sorted, not compared pair by pair.

Defined results: a null text counts as empty, has no words and the score 0;
rows are told apart by an own number, so repeated rows are scanned each; null
ids stay null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.llm.license_rules import STRENGTH, rules

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What parts words, in lower-cased and in raw texts.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def over_words(expression: str) -> str:
    """A rule's expression for text in which each word stands between two own blanks."""
    spaced = expression.replace(" ?", "( )?").replace(" ", "  ")
    return f" {spaced.replace('~', '[^ ]+')} "


def keywords(keyword: str, expression: str) -> tuple[str, str]:
    """The rule's keyword and, where each match holds it, the more telling ``licen``."""
    fixed = expression
    while (cut := re.sub(r"\([^()]*\)\??", " ", fixed)) != fixed:
        fixed = cut
    return ("licen" if "licen" in fixed else keyword), keyword


def signatures() -> list[dict]:
    """All rules with their gates, then the base phrases (tier 4)."""
    found = [(label, tier, expression, *keywords(keyword, expression)) for label, tier, keyword, expression in rules()]
    found += [(label, 4, phrase, "licen", phrase.split()[0]) for phrase, label in BASE.items()]
    return [{"ord": i, "label": label, "tier": tier, "pattern": over_words(e), "gate": gate, "keyword": keyword}
            for i, (label, tier, e, gate, keyword) in enumerate(found)]


def _words(text: Column, gaps: str) -> Column:
    return F.filter(F.split(text, gaps, -1), lambda w: w != "")


def _spaced_words(text: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(_words(F.translate(text, UPPER, UPPER.lower()), GAPS), "  "), F.lit(" "))


def _word_count(c: Column) -> Column:
    return ((F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))) / 2).cast("int")


def detections(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n_words, label, tier, start, end, kept): every detection of
    every text, with words counted from 0 and ``end`` exclusive; ``kept`` tells
    whether it outlasts the others.  Texts without any have one row of nulls."""
    known = signatures()
    table = F.array(*[F.struct(F.lit(s["ord"]).alias("ord"), F.lit(s["gate"]).alias("gate"), F.lit(s["keyword"]).alias("keyword"),
                               F.lit(s["pattern"]).alias("pattern")) for s in known])
    t = F.coalesce(F.col(text), F.lit(""))
    gated = F.lit(False)
    for word in sorted({s["gate"] for s in known}):
        gated = gated | F.col("_lower").contains(word)

    def matches(rule: Column) -> Column:
        pairs = F.zip_with(F.split(F.col("_words"), rule["pattern"], -1), F.regexp_extract_all(F.col("_words"), rule["pattern"], F.lit(0)),
                           lambda gap, m: F.struct(_word_count(gap).alias("gap"), _word_count(m).alias("length")))
        return F.transform(F.filter(pairs, lambda p: p["length"].isNotNull()),
                           lambda p, i: F.struct(rule["ord"].alias("ord"), i.alias("nth"), p["gap"].alias("gap"), p["length"].alias("length")))

    gates = lambda r: F.col("_words").contains(r["gate"]) & F.col("_words").contains(r["keyword"])
    found = F.when(F.col("_words").isNotNull(), F.flatten(F.transform(F.filter(table, gates), matches)))
    rows = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), t.alias("_text"), F.lower(t).alias("_lower"))
            .select("row", "doc_id", F.size(_words(F.col("_text"), RAW_GAPS)).cast("long").alias("n_words"),
                    F.when(gated, _spaced_words(F.col("_text"))).alias("_words"))
            .select("row", "doc_id", "n_words", F.explode_outer(found).alias("m")).select("row", "doc_id", "n_words", "m.*")
            .repartition("row"))
    nth = F.col("ord") + 1
    told = lambda key: F.element_at(F.array(*[F.lit(s[key]) for s in known]), nth)
    along = Window.partitionBy("row", "ord").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(along))
              .withColumn("start", F.col("end") - F.col("length"))
              .withColumn("tier", F.when(F.col("ord").isNotNull(), told("tier")))
              .withColumn("label", F.when(F.col("ord").isNotNull(), told("label"))))
    rule = F.col("tier") < 4
    order = Window.partitionBy("row").orderBy("start", F.desc("end"), "ord")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # the rows that follow, read backwards: a frame to the end of the group would be computed anew for each row
    after = Window.partitionBy("row").orderBy(F.desc("start"), "end", F.desc("ord")).rowsBetween(Window.unboundedPreceding, -1)
    outer = placed.withColumn("alone", rule & (F.coalesce(F.max(F.when(rule, F.col("end"))).over(before), F.lit(0)) < F.col("end")))
    overlaps = F.lit(False)
    for tier in (1, 2):
        strong = F.col("alone") & (F.col("tier") <= tier)
        met = ((F.coalesce(F.max(F.when(strong, F.col("end"))).over(before), F.lit(0)) > F.col("start"))
               | F.coalesce(F.min(F.when(strong, F.col("start"))).over(after) < F.col("end"), F.lit(False)))
        overlaps = overlaps | ((F.col("tier") > tier) & met)
    return (outer.withColumn("kept", F.col("alone") & ~overlaps)
            .select("row", "doc_id", "n_words", "label", "tier", "start", "end", "kept"))


def licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts and places of the base phrases, the labels
    and the strength of the strongest detection (0 without any)."""
    base, kept = F.col("tier") == 4, F.col("kept")
    names = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    strength = F.element_at(F.array(*[F.lit(STRENGTH[k]) for k in sorted(STRENGTH)]), F.col("tier"))
    return (detections(docs, id_col, text).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"), names(base).alias("base_labels"),
        names(base | kept).alias("labels"), F.coalesce(F.max(F.when(base | kept, strength)), F.lit(0.0)).alias("score"))
        .drop("row"))


def oracle() -> str:
    """The same in DuckDB: every rule on every text, intervals compared pair by pair."""
    lit = lambda s: "'" + s.replace("'", "''") + "'"
    values = ",\n  ".join(f"({s['ord']}, {s['tier']}, {lit(s['label'])}, {lit(s['pattern'])})" for s in signatures())
    strength = " ".join(f"WHEN {k} THEN {v}" for k, v in STRENGTH.items())
    return rf"""
WITH rules(ord, tier, label, pattern) AS (VALUES
  {values}),
d AS (
  SELECT row, doc_id, len(ws) AS n_words, ' ' || array_to_string(ws, '  ') || ' ' AS t
  FROM (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
          translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents)),
m AS (
  SELECT row, ord, tier, label, unnest(range(len(ms))) AS i, unnest(ms) AS m, unnest(gaps[1:len(ms)]) AS gap
  FROM (SELECT d.row, r.*, regexp_extract_all(d.t, r.pattern) AS ms, string_split_regex(d.t, r.pattern) AS gaps
        FROM d, rules r) WHERE len(ms) > 0),
n AS (SELECT *, (length(m) - length(replace(m, ' ', ''))) // 2 AS size, (length(gap) - length(replace(gap, ' ', ''))) // 2 AS skip FROM m),
p AS (SELECT row, ord, tier, label, size, sum(size + skip) OVER (PARTITION BY row, ord ORDER BY i) AS stop FROM n),
q AS (SELECT row, ord, tier, label, CAST(stop - size AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM p),
a AS (
  SELECT * FROM q WHERE tier < 4 AND NOT EXISTS (
    SELECT 1 FROM q o WHERE o.row = q.row AND o.tier < 4 AND o.start <= q.start AND o.stop >= q.stop
    AND (o.stop - o.start > q.stop - q.start OR o.ord < q.ord))),
k AS (
  SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM a o WHERE o.row = a.row AND o.tier < a.tier AND o.start < a.stop AND o.stop > a.start)
  UNION ALL SELECT * FROM q WHERE tier = 4),
g AS (
  SELECT row, count(*) FILTER (tier = 4) AS n_base, min(start) FILTER (tier = 4) AS first_word,
         max(start) FILTER (tier = 4) AS last_word,
         coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (tier = 4)), ','), '') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(CASE tier {strength} END) AS score
  FROM k GROUP BY row)
SELECT d.doc_id, CAST(d.n_words AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN g ON d.row = g.row"""
