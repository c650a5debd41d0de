"""Filter interaction audit by the Hart-Mas-Colell potential.

Which documents does a chain of filters remove, at which step, and how much of
it is owed to each filter whatever the order?  For a set S of filters let v(S)
be the number of documents that fail any filter of S (the removal game).  All
answers follow from v over the 2**n coalitions:

* the documents a filter removes after those of S is v(S + f) - v(S); the same
  difference over the good (toxic) documents gives what is lost of them;
* the potential P of a game is 0 for no filter and else
  P(S) = (v(S) + sum of P(S - f) over f in S) / \\|S\\|; the Shapley value of f
  is P(all) - P(all - f).  Times lcm(1..n) every potential is a whole number,
  and times n! the value is the sum of f's removals over all n! orders.

A document is reduced to the mask of the filters it fails.  Texts that are
equal share all masks but the bit of "repeats a smaller id", so copies are
counted before they meet: rows are summed by (text, part, id, labels), then by
(text, part, labels) with the smallest id and its rows, both partial before
their shuffle, and at last by (part, mask).  The texts themselves are not
shuffled, only their SHA-256.  The coalition table holds one row for a part.

Defined results: null texts are empty, so null and empty texts are copies of
one another; a null part is the empty string; an id counts as good (toxic) if
any of its label rows says 1; rows that repeat an id are documents of their
own, equal ones no copies of each other (no id is smaller); a null id is
neither smaller nor larger than any, and has no labels; an empty table has no
parts and gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial, lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.llm.common import WORD

#: The filters' letters; bit i of a mask is the i-th one.
FILTERS = "ABCDE"
GAMES = ("all", "good", "toxic")
_BLANKS = r"[\x20\x09-\x0D]+"


def text_failures(text: Column) -> tuple[Column, Column]:
    """The words of a text, to be named ``_words``, and the mask of the filters that look at one text (A to D)."""
    words = F.filter(F.split(text, _BLANKS, -1), lambda w: w != "")
    n = F.size("_words")
    fails = [n < 100, 100 * F.size(F.array_distinct("_words")) < 80 * n,
             100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text), text.rlike("[#$%&*|]")]
    return words, reduce(lambda a, b: a + b, [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)])


def failure_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                  part: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, n): documents by the set of filters they fail."""
    words, mask = text_failures(F.col("t"))
    known = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = (known.withColumn("_words", words)
            .select("id", "part", F.sha2(F.col("t").cast("binary"), 256).alias("copy"), mask.alias("mask"))
            .groupBy("copy", "part", "mask", "id").agg(F.count(F.lit(1)).alias("n")))
    # rows without an id match no label: they are dealt by their text instead
    spread = lambda c: F.when(F.col(c).isNull(), F.xxhash64("copy")).otherwise(F.lit(0))
    marked = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id"))
              .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
              .where("good = 1 OR toxic = 1").withColumn("label_part", F.lit(0).cast("bigint")))
    on = (F.col("id") == F.col("label_id")) & (F.col("spread") == F.col("label_part"))
    told = (rows.withColumn("spread", spread("id").cast("bigint")).join(marked, on, "left")
            .withColumn("good", F.coalesce("good", F.lit(0))).withColumn("toxic", F.coalesce("toxic", F.lit(0))))
    # the rows of the smallest id ride along with it
    groups = (told.groupBy("copy", "part", "mask", "good", "toxic")
              .agg(F.sum("n").alias("n"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"),
                   F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("without_id")))
    # at most one row for a part and label of the same text
    first = F.min("least.id").over(Window.partitionBy("copy"))
    kept = F.col("without_id") + F.when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = (groups.withColumn("first", first).withColumn("kept", kept)
             .select("part", "good", "toxic", F.explode(F.array(
                 F.struct(F.col("mask").alias("mask"), F.col("kept").alias("n")),
                 F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - F.col("kept")).alias("n"))))
                 .alias("x")).select("part", "good", "toxic", "x.mask", "x.n").where("n > 0"))
    return split.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def coalition_values(masks: DataFrame, filters: int = len(FILTERS)) -> DataFrame:
    """(part, total, all, good, toxic): arrays with v(S) of the three removal games, S as a mask."""
    weight = {"all": F.col("n"), "good": F.col("n") * F.col("good"), "toxic": F.col("n") * F.col("toxic")}
    v = lambda g, s: F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, weight[g]).otherwise(0)).alias(f"{g}{s}")
    sums = masks.groupBy("part").agg(F.sum("n").alias("total"), *[v(g, s) for g in GAMES for s in range(1 << filters)])
    return sums.select("part", "total", *[F.array(*[F.col(f"{g}{s}") for s in range(1 << filters)]).alias(g) for g in GAMES])


def potentials(values: DataFrame, game: str = "all", out: str = "potential", filters: int = len(FILTERS)) -> DataFrame:
    """``values`` with the game's potentials as whole numbers, P(S) * lcm(1..n).

    The recursion runs over the coalitions by size, one projection a size."""
    scale = lcm(*range(1, filters + 1))
    made = values.withColumn("_p0", F.lit(0).cast("bigint"))
    by_size = [[s for s in range(1 << filters) if s.bit_count() == k] for k in range(filters + 1)]
    for size, coalitions in enumerate(by_size[1:], 1):
        p = {}
        for s in coalitions:
            smaller = reduce(lambda a, b: a + b, [F.col(f"_p{s ^ (1 << f)}") for f in range(filters) if s >> f & 1])
            p[f"_p{s}"] = _whole(scale * F.col(game)[s] + smaller, size)
        made = made.withColumns(p)
    return made.select(*values.columns, F.array(*[F.col(f"_p{s}") for s in range(1 << filters)]).alias(out))


def _whole(c: Column, by: int) -> Column:
    """``c / by`` for a whole number that ``by`` divides."""
    return F.call_function("div", c, F.lit(by)).cast("bigint")


def audit(values: DataFrame, letters: str = FILTERS) -> DataFrame:
    """One row per (part, order of the filters, step); ``values`` as of ``coalition_values``."""
    n = len(letters)
    orders = [F.struct(F.lit("".join(letters[f] for f in order)).alias("filter_order"), F.lit(step + 1).alias("step"),
                       F.lit(sum(1 << f for f in order[:step])).alias("before"), F.lit(order[step]).alias("f"))
              for order in permutations(range(n)) for step in range(n)]
    every, scale = (1 << n) - 1, factorial(n) // lcm(*range(1, n + 1))
    bit = F.element_at(F.array(*[F.lit(1 << f) for f in range(n)]), F.col("f") + 1)
    at = lambda game, s: F.get(F.col(game), s)
    gone = lambda game: at(game, F.col("after")) - at(game, F.col("before"))
    without = F.lit(every) - F.col("bit")
    return (potentials(values, filters=n).withColumn("o", F.explode(F.array(*orders))).select("*", "o.*")
            .withColumn("bit", bit).withColumn("after", F.col("before") + F.col("bit"))
            .select("part", "filter_order", "step", (F.col("total") - at("all", F.col("after"))).alias("kept"),
                    gone("all").alias("removed"), (at("all", F.col("bit")) - gone("all")).alias("redundant"),
                    (at("all", F.lit(every)) - at("all", without)).alias("unique_fails"),
                    gone("good").alias("good_lost"), gone("toxic").alias("toxic_lost"),
                    (scale * (at("potential", F.lit(every)) - at("potential", without))).cast("bigint").alias("shapley")))


def audit_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(coalition_values(failure_masks(docs, labels)))


#: The same rows by walking every order; the Shapley sums are plain sums over the walks.
ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM t),
d AS (
  SELECT part, len(ws) < 100 AS a, 100 * len(list_distinct(ws)) < 80 * len(ws) AS b,
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > first_id, false) AS e,
         doc_id IS NOT NULL AND doc_id IN (SELECT l.doc_id FROM labels l WHERE l.quality = 1 AND l.doc_id IS NOT NULL) AS good,
         doc_id IS NOT NULL AND doc_id IN (SELECT l.doc_id FROM labels l WHERE l.toxic = 1 AND l.doc_id IS NOT NULL) AS toxic
  FROM w),
m AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
         || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails, good, toxic, count(*) AS n
  FROM d GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT f1.x || f2.x || f3.x || f4.x || f5.x AS filter_order
  FROM f f1, f f2, f f3, f f4, f f5
  WHERE len(list_distinct([f1.x, f2.x, f3.x, f4.x, f5.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS earlier
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (
  SELECT part, filter_order, step, x,
         sum(n) FILTER (left_over AND NOT now) AS kept, sum(n) FILTER (left_over AND now) AS removed,
         sum(n) FILTER (NOT left_over AND now) AS redundant, sum(n) FILTER (fails = x) AS unique_fails,
         sum(n) FILTER (left_over AND now AND good) AS good_lost, sum(n) FILTER (left_over AND now AND toxic) AS toxic_lost
  FROM (SELECT m.*, s.*, translate(fails, earlier, '') = fails AS left_over, contains(fails, x) AS now FROM m, s)
  GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""
