"""Line deduplication by overlapping three-line windows.

Every three consecutive lines of a document are one window, known by a
128-bit hash of the lines without their outer blanks.  The first occurrence of
a window, in the order of (id, position), stays.  Every later one covers three
positions of its document; covered positions are merged and those lines go.
A removed line always has an equal one at an earlier place, so no line of the
corpus is lost altogether.

With ``long_words`` (the pipeline's stage: 50) a passage of one or two lines
that holds so many words is a window by itself, whatever stands around it.
Passages that share only a part of a line are not caught.

Only DataFrame functions: windows are counted with map-side partial sums, a
passage that a third of all documents share is one row after them; occurrences
meet the repeated windows in an equi-join whose hot keys Spark splits.

Defined results: null texts stay null and empty ones empty; documents of
fewer than three lines have no window and stay as they are; windows of three
blank lines do not count; null ids come first; rows that repeat an id with an
equal text are one document (they lose the same lines); an empty table gives
an empty result; all columns are kept, helper names never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import WORD, fresh

BLANKS = " \t\r"
SPAN = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def long_windows(docs: DataFrame, words: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, mark, pos, h1, h2, span): windows of one line of ``words`` words or
    more, and of two lines that reach them together and not by themselves."""
    lines = F.transform(_lines(F.col("t")), lambda x: F.trim(x, F.lit(BLANKS)))
    # a text with fewer characters cannot hold so many words
    count = lambda x: F.regexp_count(x, F.lit(WORD))
    at = lambda k: F.element_at("l", F.col("i") + k)
    n = lambda k: F.element_at("n", F.col("i") + k)
    two = (F.col("i") < F.size("l")) & (n(0) < words) & (n(0) > 0)
    rows = (docs.where(F.length(text) >= 2 * words - 1)
            .select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("t"))
            .select("doc", "mark", lines.alias("l")).withColumn("n", F.transform("l", count))
            .withColumn("i", F.explode(F.sequence(F.lit(1), F.size("l")))))
    one = rows.where(n(0) >= words).select("doc", "mark", (F.col("i") - 1).alias("pos"), F.xxhash64(at(0)).alias("h1"),
                                           F.xxhash64(F.lit(1), at(0), F.length(at(0))).alias("h2"), F.lit(1).alias("span"))
    pair = rows.where(two).where((n(1) < words) & (n(1) > 0) & (n(0) + n(1) >= words)) \
        .select("doc", "mark", (F.col("i") - 1).alias("pos"), F.xxhash64(at(0), at(1)).alias("h1"),
                F.xxhash64(F.lit(2), at(1), at(0)).alias("h2"), F.lit(2).alias("span"))
    return one.unionByName(pair)


def window_occurrences(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, mark, pos, h1, h2, span): a row for each window; ``mark`` tells the texts of one id apart."""
    lines = F.transform(_lines(F.col("t")), lambda x: F.trim(x, F.lit(BLANKS)))
    at = lambda k: F.element_at(F.col("l"), F.col("pos") + k)
    return (docs.where(F.col(text).contains("\n"))
            .select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("t"))
            .select("doc", "mark", lines.alias("l")).where(F.size("l") >= SPAN)
            .select("doc", "mark", F.explode(F.transform(
                F.sequence(F.lit(1), F.size("l") - SPAN + 1),
                lambda i: F.struct(
                    (i - 1).alias("pos"),
                    F.xxhash64(F.element_at("l", i), F.element_at("l", i + 1), F.element_at("l", i + 2)).alias("h1"),
                    F.xxhash64(F.lit(SPAN), F.element_at("l", i + 2), F.element_at("l", i + 1), F.element_at("l", i)).alias("h2"),
                    (F.length(F.element_at("l", i)) + F.length(F.element_at("l", i + 1)) + F.length(F.element_at("l", i + 2))
                     > 0).alias("any")))).alias("w"))
            .where("w.any").select("doc", "mark", "w.pos", "w.h1", "w.h2", F.lit(SPAN).alias("span")))


def later_occurrences(occurrences: DataFrame) -> DataFrame:
    """(doc, mark, pos, span) of every occurrence of a repeated window but its first."""
    firsts = (occurrences.groupBy(F.col("h1").alias("k1"), F.col("h2").alias("k2"))
              .agg(F.min(F.struct("doc", "pos", "mark")).alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1"))
    same = (F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("pos") == F.col("first.pos"))
            & (F.col("mark") == F.col("first.mark")))
    return (occurrences.join(firsts, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
            .where(~same).select("doc", "mark", "pos", "span"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", report: bool = False,
                long_words: int | None = None) -> DataFrame:
    """``docs`` without repeated passages; with ``report`` also the columns
    ``n_lines`` and ``removed_lines`` (in place of any of those names).  With
    ``long_words``, one or two lines that hold so many words are a window too."""
    windows = window_occurrences(docs, id_col, text)
    if long_words:
        windows = windows.unionByName(long_windows(docs, long_words, id_col, text))
    later = later_occurrences(windows).withColumn("pos", F.explode(F.sequence("pos", F.col("pos") + F.col("span") - 1)))
    # a document's own positions: bounded by its text
    covered = (later.groupBy("doc", "mark").agg(F.sort_array(F.collect_set("pos")).alias("covered"))
               .select(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"), "covered"))
    mark, doc, same, hit, lines, kept = fresh(docs, "mark", "doc_key", "mark_key", "covered", "lines", "kept")
    covered = covered.toDF(doc, same, hit)
    marked = docs.withColumn(mark, F.xxhash64(F.col(text)))
    joined = marked.join(covered, F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(mark) == F.col(same)), "left")
    # the stretches before, between and after the covered lines
    m = F.size(hit)
    start = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.element_at(hit, F.greatest(k, F.lit(1))) + 1)
    end = lambda k: F.when(k == m, F.size(lines)).otherwise(F.element_at(hit, F.least(k + 1, m)))
    pieces = F.flatten(F.transform(F.sequence(F.lit(0), m), lambda k: F.slice(
        F.col(lines), start(k) + 1, F.greatest(end(k) - start(k), F.lit(0)))))
    cut = joined.withColumn(lines, F.when(F.col(hit).isNotNull(), _lines(F.col(text)))) \
        .withColumn(kept, F.when(F.col(hit).isNotNull(), pieces))
    new_text = F.when(F.col(hit).isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text))
    if not report:
        return cut.withColumn(text, new_text).select(*docs.columns)
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "removed_lines")]
    n_lines = F.when(F.col(hit).isNotNull(), F.size(lines)) \
        .otherwise(F.length(text) - F.length(F.translate(F.col(text), "\n", "")) + 1)
    gone = F.when(F.col(hit).isNotNull(), F.size(lines) - F.size(kept)).otherwise(F.lit(0))
    return cut.select(*[new_text.alias(c) if c == text else F.col(c) for c in names],
                      F.coalesce(n_lines, F.lit(0)).cast("int").alias("n_lines"), gone.cast("int").alias("removed_lines"))


#: The same result from plain lines instead of hashes.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS raw,
         list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))) AS l
  FROM documents),
w AS (
  SELECT doc_id, text, i AS pos, l[i + 1] || chr(10) || l[i + 2] || chr(10) || l[i + 3] AS win
  FROM (SELECT doc_id, text, l, unnest(range(len(l) - 2)) AS i FROM d WHERE len(l) >= 3)
  WHERE length(l[i + 1]) + length(l[i + 2]) + length(l[i + 3]) > 0),
r AS (
  SELECT doc_id, text, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM w),
c AS (
  SELECT doc_id, text, list(DISTINCT p) AS gone
  FROM (SELECT doc_id, text, unnest([pos, pos + 1, pos + 2]) AS p FROM r WHERE nth > 1) GROUP BY ALL)
SELECT d.doc_id,
       CASE WHEN c.gone IS NULL THEN d.text ELSE
         coalesce(array_to_string([d.raw[i + 1] for i in range(len(d.raw)) if NOT list_contains(c.gone, i)], chr(10)), '') END AS text,
       CAST(coalesce(len(d.raw), 0) AS INTEGER) AS n_lines,
       CAST(coalesce(len(c.gone), 0) AS INTEGER) AS removed_lines
FROM d LEFT JOIN c ON d.doc_id = c.doc_id AND d.text = c.text
"""
