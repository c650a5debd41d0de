"""Mixing sources to target sizes by Pareto order sampling.

The sources, in code-point order with null last, weigh 5, 2, 1, 5, 2, 1, ...
and share ``BUDGET`` times the words of the corpus.  A source's target stops
at ``MAX_REPEAT`` times its words; what lies above is shared among the rest by
weight until no target is above.  A source whose target is t times its words
gives floor(t) certain whole copies of every document.  The words still left
are drawn with unequal probabilities, in proportion to a document's size x:
p = min(1, c x), with c such that the expected words, the sum of p x, are those
left.  Documents with p = 1 are certain and get their copy.  The others are
ranked by Pareto's ratio, random odds over inclusion odds,
(u / (1 - u)) / (p / (1 - p)), and taken in that order up to the document that
brings the words nearest to what is left: the sample's size is fixed, in words.

c follows from the histogram of a source's sizes: with the k largest sizes
certain it is (words left - their words) / (sum of x * x of the rest), and the
first k for which the largest size of the rest stays below 1 holds.  A corpus of
W words has at most sqrt(2 W) different sizes in a source, so that is what a
source's histogram may have.

u comes from a digest of id and text, so reruns agree.  Only DataFrame
functions: a source's documents are ranked in buckets of the ratio (scaled by
the odds of the source's share, which spreads it over 0 to 1), so one source may
hold most of the corpus; only (source, bucket) sums meet in one place, and one
row per source in the table of targets.

Defined results: a null text and one without words have 0 words, are never
drawn and get their source's certain copies alone; null sources form one source;
repeated rows are drawn separately; a source without words has target 0; an
empty table gives an empty result; clashing column names are kept, helpers
are renamed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.llm.common import WORD, fresh, materialise, ranked

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_REPEAT = 2
BUCKET_ROWS = 5_000
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(id_col: Column, text: Column) -> Column:
    """A number above 0 and below 1 from a digest: 48 bits and a half step."""
    own = F.concat_ws(":", F.lit(SEED), F.coalesce(id_col.cast("string"), F.lit("")),
                      F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return (F.conv(F.substring(F.md5(own.cast("binary")), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sized: DataFrame, source: str, size: str) -> DataFrame:
    """(s, source_size, target): one row per source.

    By rising room per weight, a source is full if its room lies at or below
    the level that the words still to share give to the sources not yet full;
    the first source that is not full has the final level.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("s").asc_nulls_last())
    nth = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS))) + 1
    table = (sized.groupBy(F.col(source).alias("s")).agg(F.sum(size).cast("double").alias("words"))
             .withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), nth))
             .withColumn("most", F.col("words") * float(MAX_REPEAT)).withColumn("room", F.col("most") / F.col("w")))
    before = Window.orderBy("room", F.col("s").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    spent = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    level = ((F.sum("words").over(everything) * BUDGET - spent("most")) / (F.sum("w").over(everything) - spent("w")))
    leveled = table.withColumn("level", level).withColumn("full", F.col("room") <= F.col("level"))
    final = leveled.withColumn("final", F.min(F.when(~F.col("full"), F.struct("room", "level"))).over(everything))
    target = F.when(F.col("final").isNull() | (F.col("room") < F.col("final.room")), F.col("most")) \
        .otherwise(F.least(F.col("final.level") * F.col("w"), F.col("most")))
    return final.select("s", F.col("words").cast("long").alias("source_size"), target.alias("target"))


def inclusion(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """From the histogram (of, x, n) of the sources' sizes: ``targets`` with ``whole`` (certain copies of every document), ``most``
    (documents with more words are certain once more), ``c``, and of the
    documents that are drawn ``room`` (the words to take) and ``share`` (of their words)."""
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MAX_REPEAT))).otherwise(F.lit(0))
    known = targets.withColumn("whole", whole.cast("int")).withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    some = sizes.where("x > 0").join(known.select("s", "left"), F.col("of").eqNullSafe(F.col("s")))
    larger = Window.partitionBy("of").orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, -1)
    words, squares = F.col("n") * F.col("x"), F.col("n") * F.col("x") * F.col("x")
    before = F.coalesce(F.sum(words).over(larger), F.lit(0))
    rest = F.sum(squares).over(Window.partitionBy("of")) - F.coalesce(F.sum(squares).over(larger), F.lit(0))
    levels = (some.withColumn("certain", before).withColumn("c", (F.col("left") - before) / rest)
              .where(F.col("c") * F.col("x") < 1).groupBy("of").agg(F.max(F.struct("x", "c", "certain")).alias("m")))
    room = F.col("left") - F.col("m.certain")
    return (known.join(levels, F.col("s").eqNullSafe(F.col("of")), "left")
            .select("s", "source_size", "target", "whole", F.col("m.x").alias("most"), F.col("m.c").alias("c"), room.alias("room"),
                    (room / F.nullif(F.col("source_size") - F.col("m.certain"), F.lit(0))).alias("share")))


def pareto(u: Column, p: Column, share: Column) -> Column:
    """Between 0 and 1, rising with Pareto's ratio of u's odds to p's."""
    ratio = (share / (1 - share)) * ((u / (1 - u)) / (p / (1 - p)))
    return ratio / (1 + ratio)


def take(sized: DataFrame, source: str, size: str, u: str, id_col: str) -> DataFrame:
    """Rows of ``sized`` with ``source_size``, ``target`` and ``copies``
    (which the frame must not have yet)."""
    s, whole, most, c, room, share, v, rank, before = names = fresh(
        sized, "mix_source", "mix_whole", "mix_most", "mix_c", "mix_room", "mix_share", "mix_order", "mix_rank", "words_before")
    sizes = materialise(sized.groupBy(F.col(source).alias("of"), F.col(size).alias("x")).agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    targets = source_targets(sizes.select("of", (F.col("n") * F.col("x")).alias("words")), "of", "words")
    plan = materialise(inclusion(sizes, materialise(targets, "mix-targets")), "mix-plan")
    plan = plan.select(F.col("s").alias(s), "source_size", "target", *[F.col(a).alias(b) for a, b in (
        ("whole", whole), ("most", most), ("c", c), ("room", room), ("share", share))])
    joined = sized.join(plan, F.col(source).eqNullSafe(F.col(s)), "left")
    # drawn: some words are left to take, and the document is neither empty nor certain
    drawn = F.coalesce((F.col(room) > 0) & (F.col(size) > 0) & (F.col(size) <= F.col(most)), F.lit(False))
    certain = F.coalesce((F.col(size) > F.col(most)) & (F.col(whole) < MAX_REPEAT), F.lit(False))
    sure = joined.where(~drawn).withColumn("copies", (F.col(whole) + certain.cast("int")).cast("int"))
    buckets = max(1024, sized.count() // BUCKET_ROWS)
    ordered = joined.where(drawn).withColumn(v, pareto(F.col(u), F.col(c) * F.col(size), F.col(share)))
    numbered = ranked(ordered, [source], [F.col(v), F.col(id_col), F.col(size)],
                      F.least(F.floor(F.col(v) * buckets), F.lit(buckets - 1)), rank, size, before)
    one_more = (2 * F.col(before) + F.col(size) < 2 * F.col(room)) & (F.col(whole) < MAX_REPEAT)
    return (numbered.withColumn("copies", (F.col(whole) + one_more.cast("int")).cast("int")).drop(*names)
            .unionByName(sure.drop(*names)))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is copied."""
    inner = [f"c{i}" for i in range(len(docs.columns))]  # clash-free inside
    by = dict(zip(docs.columns, inner))
    sized = docs.toDF(*inner).withColumn("size", n_words(F.col(by["text"]))) \
        .withColumn("u", uniform(F.col(by["doc_id"]), F.col(by["text"])))
    taken = take(sized, by["source"], "size", "u", by["doc_id"]).where("copies > 0")
    return (taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[F.col(c).alias(n) for n, c in by.items()]))


def mixing_query(docs: DataFrame) -> DataFrame:
    sized = materialise(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                                    uniform(F.col("doc_id"), F.col("text")).alias("u")), "mix-sizes")
    taken = take(sized, "source", "size", "u", "doc_id")
    return taken.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).cast("long").alias("taken"))


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
         (CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 12) AS BIGINT)
          + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
  FROM documents),
s AS (
  SELECT source, words, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w
  FROM (SELECT source, CAST(sum(size) AS DOUBLE) AS words FROM d GROUP BY source)),
l AS (
  SELECT *, 2 * words / w AS room,
         (sum(words) OVER () * 1.5 - coalesce(sum(2 * words) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM s WINDOW b AS (ORDER BY 2 * words / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(level, room) AS level, min(room) AS room FROM l WHERE room > level),
t AS (
  SELECT l.source, CAST(words AS BIGINT) AS source_size,
         CASE WHEN f.room IS NULL OR l.room < f.room THEN 2 * words ELSE least(f.level * w, 2 * words) END AS target
  FROM l LEFT JOIN f ON true),
a AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(least(floor(target / source_size), 2) AS INTEGER) ELSE 0 END AS whole FROM t),
h AS (
  SELECT a.source, x, n, a.target - a.whole * a.source_size AS rem
  FROM (SELECT source, size AS x, count(*) AS n FROM d WHERE size > 0 GROUP BY ALL) z JOIN a ON z.source IS NOT DISTINCT FROM a.source),
k AS (
  SELECT *, (rem - certain) / rest AS c FROM (
    SELECT source, x, rem, CAST(coalesce(sum(n * x) OVER b, 0) AS BIGINT) AS certain,
           CAST(sum(n * x * x) OVER (PARTITION BY source) - coalesce(sum(n * x * x) OVER b, 0) AS BIGINT) AS rest
    FROM h WINDOW b AS (PARTITION BY source ORDER BY x DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
i AS (SELECT source, max(x) AS most, arg_max(c, x) AS c, arg_max(rem - certain, x) AS room, arg_max(certain, x) AS certain
      FROM k WHERE c * x < 1 GROUP BY source),
q AS (
  SELECT d.*, a.source_size, a.target, a.whole, i.most, i.room, i.room / nullif(a.source_size - i.certain, 0) AS share, i.c * d.size AS p
  FROM d JOIN a ON d.source IS NOT DISTINCT FROM a.source LEFT JOIN i ON d.source IS NOT DISTINCT FROM i.source),
v AS (
  SELECT *, coalesce(room > 0 AND size > 0 AND size <= most, false) AS drawn,
         CASE WHEN room > 0 AND size > 0 AND size <= most THEN (share / (1 - share)) * ((u / (1 - u)) / (p / (1 - p))) END AS ratio FROM q),
r AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, drawn ORDER BY ratio / (1 + ratio), doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM v)
SELECT doc_id, size, source_size, target,
       CAST((whole + CASE WHEN whole < 2 AND (CASE WHEN drawn THEN 2 * before + size < 2 * room ELSE coalesce(size > most, false) END)
                          THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM r
"""
