"""Event-pattern detection on keyed, time-ordered events (batch form).

Strict sequences (``begin.where(p0).next.where(p1)...`` and
``times(n).consecutive()``) report every run of n *adjacent* events of a key
whose i-th event satisfies predicate i; overlapping matches are all reported
(no skip strategy).  Instead of ``lead()`` over a per-key window, each event
gets its position in the key (``plans.ordered.sequence_number``, hot keys
split) and every event that satisfies predicate i votes for the match
starting i positions earlier.  Grouping on ``(key, start)`` — nearly unique,
so no skew — and keeping groups with all n votes gives the matches: one
shuffle with partial aggregation and at most n values per group.

Relaxed sequences with a deadline (``begin(a).followedBy(b).within(t)``):
each ``a`` event is matched with the first later ``b`` event of its key;
it is a match when ``b.ts - a.ts < t`` and a time-out otherwise (including
no ``b`` at all — a bounded input closes every partial match at its end).
The first later ``b`` is a suffix minimum (``plans.ordered.running`` in
descending order), again without gathering a key in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.plans.ordered import running, sequence_number

STATUS_MATCHED = "matched"
STATUS_TIMEOUT = "timeout"


def match_sequence(df: DataFrame, key: str, order: list[str], predicates: list[Column],
                   fields: list[str]) -> DataFrame:
    """One row per match: ``key, start_seq, events`` where ``events`` is the
    array of matched events (struct of ``step`` and ``fields``) in order."""
    n = len(predicates)
    seq = sequence_number(df, [key], order, out="_seq")
    # every (event, step) pair where the event satisfies that step's predicate
    votes = F.filter(
        F.array(*[F.when(p, F.lit(i)) for i, p in enumerate(predicates)]),
        lambda x: x.isNotNull())
    exploded = (seq.select(key, "_seq", *fields, F.explode(votes).alias("step"))
                .withColumn("start_seq", F.col("_seq") - F.col("step")))
    grouped = (exploded.groupBy(key, "start_seq")
               .agg(F.count(F.lit(1)).alias("_n"),
                    F.sort_array(F.collect_list(F.struct("step", *fields))).alias("events"))
               .where((F.col("_n") == n) & (F.col("start_seq") >= 1)))
    return grouped.drop("_n")


def strict_sequence(df: DataFrame, key: str, order: list[str], predicates: list[Column],
                    time_col: str, step_names: list[str]) -> DataFrame:
    """``select``: one row per match with the time of each step as a column."""
    m = match_sequence(df, key, order, predicates, [time_col])
    return m.select(key, *[F.col("events")[i][time_col].alias(name)
                           for i, name in enumerate(step_names)])


def times_consecutive(df: DataFrame, key: str, order: list[str], predicate: Column, n: int,
                      time_col: str) -> DataFrame:
    """``times(n).consecutive()``: runs of n adjacent events that all match.
    Output: key, first and last time of the run."""
    m = match_sequence(df, key, order, [predicate] * n, [time_col])
    return m.select(key, F.col("events")[0][time_col].alias("first_ts"),
                    F.col("events")[n - 1][time_col].alias("last_ts"))


def flat_select(df: DataFrame, key: str, order: list[str], predicates: list[Column],
                fields: list[str], time_col: str) -> DataFrame:
    """``flatSelect``: one row per matched event, tagged with its match
    (first event's time) and step."""
    m = match_sequence(df, key, order, predicates, fields)
    e = m.select(key, F.col("events")[0][time_col].alias("match_ts"), F.explode("events").alias("e"))
    return e.select(key, "match_ts", F.col("e.step").alias("step"), *[F.col(f"e.{f}").alias(f) for f in fields])


def followed_by_within(df: DataFrame, key: str, time_col: str, id_col: str,
                       begin: Column, end: Column, within_ms: int,
                       begin_fields: list[str] = (), end_fields: list[str] = ()) -> DataFrame:
    """Every ``begin`` event with its first later ``end`` event of the key.

    Output: key, ``begin_ts``, ``end_ts`` (null on time-out), ``status``
    (``matched`` when ``end_ts - begin_ts < within_ms``, else ``timeout``),
    ``timeout_ts`` (``begin_ts + within_ms`` for time-outs), plus
    ``begin_``/``end_``-prefixed extra fields.
    """
    packed = F.when(end, F.struct(F.col(time_col).alias("t"), F.col(id_col).alias("i"),
                                  *[F.col(f).alias(f) for f in end_fields]))
    nxt = running(df.select(key, time_col, id_col, *set(begin_fields) | set(end_fields),
                            begin.alias("_is_begin"), packed.alias("_end")),
                  [key], [time_col, id_col], {"_next": ("min", F.col("_end"))},
                  descending=True, include_current=False)
    b = nxt.where(F.col("_is_begin"))
    ok = F.col("_next.t").isNotNull() & ((F.col("_next.t") - F.col(time_col)) < F.lit(within_ms))
    return b.select(
        key,
        F.col(time_col).alias("begin_ts"),
        *[F.col(f).alias("begin_" + f) for f in begin_fields],
        F.when(ok, F.col("_next.t")).alias("end_ts"),
        *[F.when(ok, F.col(f"_next.{f}")).alias("end_" + f) for f in end_fields],
        F.when(ok, F.lit(STATUS_MATCHED)).otherwise(F.lit(STATUS_TIMEOUT)).alias("status"),
        F.when(ok, F.lit(None).cast("bigint")).otherwise(F.col(time_col) + F.lit(within_ms)).alias("timeout_ts"),
    )
