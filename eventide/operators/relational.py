"""Projection, filters, flat-map, record text, per-task map, SQL.

All of these are narrow (no shuffle): Catalyst pushes the filters into the
parquet scan and prunes unread columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, *cols: str | Column) -> DataFrame:
    """``map(_.field)``: keep the named fields."""
    return df.select(*cols)


def filter_contains(df: DataFrame, col: str, needle: str) -> DataFrame:
    """Keep rows whose ``col`` contains ``needle`` (a substring test)."""
    return df.where(F.col(col).contains(needle))


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def flat_repeat(df: DataFrame, match_col: str, repeats: dict, emit: list[str],
                copy_col: str = "copy") -> DataFrame:
    """Flat-map with 0..n outputs per row: a row whose ``match_col`` equals a
    key of ``repeats`` is emitted that many times, all other rows vanish.

    ``copy_col`` numbers the copies 1..n so that the output rows stay
    distinguishable.
    """
    n = F.lit(0)
    for value, times in reversed(list(repeats.items())):
        n = F.when(F.col(match_col) == F.lit(value), F.lit(times)).otherwise(n)
    return (df.withColumn("_n", n)
            .where(F.col("_n") > 0)
            .select(*emit, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias(copy_col)))


def record_text_col(type_name: str, cols: list[str]) -> Column:
    """A row rendered like a case-class ``toString``: ``Name(a,b,c)``."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]
    return F.concat(F.lit(type_name + "("), F.concat_ws(",", *parts), F.lit(")"))


def record_text(df: DataFrame, type_name: str, cols: list[str], out: str = "value") -> DataFrame:
    return df.select(record_text_col(type_name, cols).alias(out))


def map_with_lifecycle(df: DataFrame, fn: Callable, schema: str,
                       open_fn: Callable[[int], object] | None = None,
                       close_fn: Callable[[object], None] | None = None) -> DataFrame:
    """Per-task map with set-up and clean-up (a "rich" map function).

    ``open_fn(partition_id)`` runs once per task before the first batch and
    returns a context; ``fn(pdf, ctx)`` maps each Arrow batch (a pandas
    DataFrame); ``close_fn(ctx)`` runs once at the end, even on failure.
    """
    def run(batches: Iterator):
        from pyspark import TaskContext
        tc = TaskContext.get()
        pid = tc.partitionId() if tc is not None else 0
        ctx = open_fn(pid) if open_fn else None
        try:
            for pdf in batches:
                yield fn(pdf, ctx)
        finally:
            if close_fn:
                close_fn(ctx)

    return df.mapInPandas(run, schema=schema)


def flat_map(df: DataFrame, fn: Callable[[dict], Iterator[tuple]], schema: str) -> DataFrame:
    """Flat-map with any code: ``fn(row)`` gets a row as a dictionary and
    yields any number of output rows (tuples in the order of ``schema``).
    Rows go to the workers in Arrow batches."""
    import pandas as pd
    names = [f.split()[0] for f in schema.split(",")]

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            yield pd.DataFrame([out for row in pdf.to_dict("records") for out in fn(row)], columns=names)

    return df.mapInPandas(run, schema=schema)


def sql_over(df: DataFrame, view: str, query: str) -> DataFrame:
    """Run SQL over ``df`` (batch or streaming), named ``{view}`` in the query.
    No view of the session is touched."""
    return df.sparkSession.sql(query, **{view: df})
