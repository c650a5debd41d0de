"""A key's rows of one micro-batch in order, without holding all of them.

Spark hands a processor the rows of a key unordered, a few thousand at a
time.  ``Replayed`` gives them to ``take`` in blocks that are sorted and
follow one another in the order.  Few rows are one block.  More are cut into
sorted runs; a run's parts wait in map state (the state store keeps them on
disk, and a lost executor's task starts over from the last commit) and are
removed as they are merged.  A task holds one run, or one part of each of
``FAN`` runs, whatever the number of rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Runs merged at a time.
FAN = 8
#: A run ends at so many rows or bytes.
RUN_ROWS, RUN_BYTES = 100_000, 32 << 20


class _Runs:
    """Sorted runs in a map from (run, part) to pickled rows."""

    def __init__(self, store, order: list[str], run_rows: int):
        self.store, self.order, self.run_rows = store, order, run_rows
        self.next_run = 0

    def write(self, blocks: Iterable[pd.DataFrame]) -> tuple[int, int]:
        run, part = self.next_run, 0
        self.next_run += 1
        for block in blocks:
            size = int(block.memory_usage(deep=True).sum())
            parts = max(-(-len(block) * FAN // self.run_rows), -(-size * FAN // RUN_BYTES), 1)
            step = -(-len(block) // parts)
            for at in range(0, len(block), step):
                self.store.updateValue((run, part), (pickle.dumps(block.iloc[at:at + step], protocol=5),))
                part += 1
        return run, part

    def _take(self, run: int, part: int) -> pd.DataFrame:
        rows = pickle.loads(bytes(self.store.getValue((run, part))[0]))
        self.store.removeKey((run, part))
        return rows

    def merge(self, runs: list[tuple[int, int]]) -> Iterator[pd.DataFrame]:
        """Blocks of all rows of ``runs`` in order.  Rows up to the first
        row that ends a loaded part are final: a run's later parts follow it."""
        loaded = [0] * len(runs)                        # parts of each run so far
        held, mark = [], np.empty(0, np.int64)          # mark: at a part's last row its run, if more of it follows
        todo = [i for i, (_, parts) in enumerate(runs) if parts]
        while todo or len(mark):
            for i in todo:
                run, parts = runs[i]
                held.append(self._take(run, loaded[i]))
                loaded[i] += 1
                mark = np.r_[mark, np.full(len(held[-1]), -1)]
                if loaded[i] < parts:
                    mark[-1] = i
            rows = pd.concat(held, ignore_index=True)
            place = rows.sort_values(self.order, kind="stable").index.to_numpy()
            rows, mark = rows.iloc[place], mark[place]
            stop = np.flatnonzero(mark >= 0)
            cut = int(stop[0]) + 1 if len(stop) else len(rows)
            todo = [int(mark[cut - 1])] if len(stop) else []
            yield rows.iloc[:cut].reset_index(drop=True)
            held, mark = [rows.iloc[cut:]], mark[cut:]


def sorted_blocks(rows: Iterable[pd.DataFrame], order: list[str], store, run_rows: int = RUN_ROWS) -> Iterator[pd.DataFrame]:
    """The rows of all frames sorted by ``order``, as frames in that order.
    Nulls come last; rows equal in ``order`` come in any order.  ``store`` is
    a map state keyed by (run, part); it is empty again at the end."""
    runs = _Runs(store, order, run_rows)
    levels: list[list[tuple[int, int]]] = []
    chunk, n, size = [], 0, 0

    def in_order() -> pd.DataFrame:
        return pd.concat(chunk, ignore_index=True).sort_values(order, kind="stable").reset_index(drop=True)

    def keep(run: tuple[int, int], level: int = 0) -> None:
        if level == len(levels):
            levels.append([])
        levels[level].append(run)
        if len(levels[level]) == FAN:
            full, levels[level] = levels[level], []
            keep(runs.write(runs.merge(full)), level + 1)

    for pdf in rows:
        if not len(pdf):
            continue
        if n and (n + len(pdf) > run_rows or size > RUN_BYTES):
            keep(runs.write([in_order()]))
            chunk, n, size = [], 0, 0
        chunk.append(pdf)
        n += len(pdf)
        size += int(pdf.memory_usage(deep=True).sum())
    if not levels:
        if n:
            yield in_order()
        return
    keep(runs.write([in_order()]))
    chunk = []
    left = [run for level in levels for run in level]       # short runs first
    while len(left) > FAN:
        left = left[FAN:] + [runs.write(runs.merge(left[:FAN]))]
    yield from runs.merge(left)


class Replayed(StatefulProcessor):
    """A processor whose ``take`` gets a key's rows in order, in blocks;
    it must leave all it knows in state between them."""

    order: list[str]
    run_rows = RUN_ROWS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = handle.getMapState("waiting", "run int, part int", "rows binary")

    def take(self, key, pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in sorted_blocks(rows, self.order, self.waiting, self.run_rows):
            yield from self.take(key, pdf)

    def close(self) -> None:
        pass


def in_runs(processor: Replayed, df: DataFrame) -> Replayed:
    """``processor`` with the session's ``eventide.replay.rows`` a run."""
    processor.run_rows = int(df.sparkSession.conf.get("eventide.replay.rows", str(RUN_ROWS)))
    return processor
