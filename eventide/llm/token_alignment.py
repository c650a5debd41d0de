"""Cross-tokenizer alignment by interval coalescing.

Two tokenizers cut the same bytes, each in its own way.  Laid over the bytes,
their tokens are intervals: all tokens of both sides are sorted by start
(``lexsort``), the ends are run through ``maximum.accumulate``, and a group
breaks where a start reaches the running maximum, which is where tokens of
both sides end.  Within the groups each A token is expanded to the B tokens
whose bytes it overlaps: the links.

Neither tokenizer joins a blank to the visible character before it, so a text
is read in units (a blank and what follows up to the next such blank), and a
worker remembers the aligned units it has met.  ``Aligner.check`` tells
whether two vocabularies allow that.

Each Arrow slice of about ``SLICE_BYTES`` is one block with a dictionary of
the id pairs in it.  Blocks are written once (with a document's pairs as
places in the dictionary); then only (block, pair) rows meet: they are summed
to the number of documents that hold a pair, compared with the largest of the
A id (at most as many rows as B has ids), and go back to their block, whose
documents sum them up.  No row of a document-pair ever travels by its pair, so
a pair that stands in every document is one row for each block.

Defined results: texts that are null, empty, or that a tokenizer does not give
back byte for byte have no tokens (zeros and an empty string); strings of
special tokens are ordinary text; rows that repeat an id are documents of
their own; null ids are kept; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.llm.common import frugal, materialise, slices, string_parts

SLICE_BYTES = 2 << 20
RUN_BYTES = 1 << 15         # units laid end to end for one call of a tokenizer
CACHE_UNITS = 80_000        # aligned units a worker remembers before it starts anew
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path(A_FILE), public_tokenizers.path(B_FILE)


# --- vocabularies -------------------------------------------------------------------

def _byte_of_sign() -> dict[str, int]:
    """The byte that a sign of a byte-level vocabulary stands for: visible
    Latin-1 bytes are themselves, the others follow from U+0100 in order."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level_entries(tokenizer) -> list[bytes]:
    sign, out = _byte_of_sign(), [b""] * tokenizer.get_vocab_size()
    for entry, i in tokenizer.get_vocab(with_added_tokens=False).items():
        out[i] = bytes(sign[c] for c in entry)
    return out


def piece_entries(model) -> list[bytes]:
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))]


# --- intervals ----------------------------------------------------------------------

def coalesce(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links of two tilings of the same bytes, given token lengths.

    Returns the group of each A and each B token, and the links as (A index, B
    index), sorted by A.
    """
    end = np.concatenate([np.cumsum(a), np.cumsum(b)])
    start = end - np.concatenate([a, b])
    side = np.repeat([0, 1], [len(a), len(b)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    fresh = np.ones(len(order), np.int64)
    fresh[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    low = np.searchsorted(end[len(a):], start[:len(a)], "right")
    high = np.searchsorted(start[len(a):], end[:len(a)], "left")
    n = high - low
    left = np.repeat(np.arange(len(a)), n)
    right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    return group[:len(a)], group[len(a):], left, right


class Aligner:
    """Two tokenizers and the aligned units met so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        self.a_bytes, self.b_bytes = byte_level_entries(self.a), piece_entries(self.b)
        self.a_size, self.b_size = (np.array([len(x) for x in v]) for v in (self.a_bytes, self.b_bytes))
        self.a_table, self.b_table = (pa.array(v, pa.binary()) for v in (self.a_bytes, self.b_bytes))
        self.digits = pa.array([str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))], pa.string())
        self.blank = self.b.piece_to_id("▁")
        self.check()
        self.forget()

    def check(self) -> None:
        """Units are exact only if no entry holds a blank behind a visible character."""
        for name, entries in (("A", self.a_bytes), ("B", self.b_bytes)):
            if any(re.search(rb"([!-~]|\xc3[\x80-\xbf]) ", e) for e in entries):
                raise ValueError(f"tokenizer {name} joins blanks to the text before them: units would not be exact")

    def forget(self) -> None:
        self.code: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.whole = np.empty(0, bool)
        self.numbers = np.empty((0, 4), np.int64)         # n_a, n_b, n_groups, n_links
        self.first = np.zeros(1, np.int64)                # of a unit's pairs
        self.pair, self.times = np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, units: list[bytes]) -> tuple[list[bytes], tuple, tuple]:
        """The units in a new order, and (ids, first id of each unit) of A and of B.

        Units that end in a visible character tokenize alike side by side and
        alone, so they are laid end to end and cut again by the bytes of the
        tokens; the others, and those whose run does not come back byte for
        byte, go one by one.
        """
        size = np.array([len(u) for u in units])
        tail = np.array([u[-1] for u in units])
        head = np.array([u[-2] if len(u) > 1 else 0 for u in units])
        joins = ((tail > 32) & (tail < 127)) | ((head == 0xC3) & (tail >= 128))
        side, alone = np.flatnonzero(joins), np.flatnonzero(~joins).tolist()
        runs = np.split(side, np.flatnonzero(np.diff(np.cumsum(size[side]) // RUN_BYTES)) + 1) if len(side) else []
        texts = [b"".join(map(units.__getitem__, r.tolist())) for r in runs]
        said = [t.decode() for t in texts]
        order, ids, counts = [], ([], []), ([], [])
        for r, text, *both in zip(runs, texts, self._a(said), self._b(said)):
            cuts, ends = np.cumsum(size[r]), [np.cumsum(n[x]) for n, x in zip((self.a_size, self.b_size), both)]
            if not all(len(e) and e[-1] == len(text) and np.isin(cuts, e).all() and b"".join(map(v.__getitem__, x.tolist())) == text
                       for e, x, v in zip(ends, both, (self.a_bytes, self.b_bytes))):
                alone += r.tolist()
                continue
            order += r.tolist()
            for k in (0, 1):
                ids[k].append(both[k])
                counts[k].append(np.diff(np.searchsorted(ends[k], cuts), prepend=-1))
        one = [units[u].decode() for u in alone]
        for k, got in enumerate((self._a(one), self._b(one))):
            ids[k].extend(got)
            counts[k].append(np.array([len(x) for x in got], np.int64))
        sides = [(np.concatenate(x), np.concatenate([[0], np.cumsum(np.concatenate(n))])) for x, n in zip(ids, counts)]
        return [units[u] for u in order + alone], *sides

    def _a(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int64) for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _b(self, texts: list[str]) -> list[np.ndarray]:
        """Texts begin with the blank that the model adds by itself, but to an empty text."""
        return [np.array(x if t != " " else [self.blank], np.int64)
                for t, x in zip(texts, self.b.encode([t[1:] for t in texts], num_threads=1))]

    def learn(self, units: list[bytes]) -> None:
        units, (a_ids, a_first), (b_ids, b_first) = self.encode(units)
        given = pa.array(units, pa.binary())
        whole = np.ones(len(units), bool)
        for ids, first, entries in ((a_ids, a_first, self.a_table), (b_ids, b_first, self.b_table)):
            back = _joined(entries.take(ids), first, b"")
            whole &= pc.equal(back, given).to_numpy(zero_copy_only=False)
        a_ids, b_ids = a_ids[np.repeat(whole, np.diff(a_first))], b_ids[np.repeat(whole, np.diff(b_first))]
        n_a, n_b = np.diff(a_first) * whole, np.diff(b_first) * whole
        a_group, b_group, left, right = coalesce(self.a_size[a_ids], self.b_size[b_ids])
        unit_of_a = np.repeat(np.arange(len(units)), n_a)
        n = int(a_group[-1]) + 1 if len(a_group) else 0
        unit_of_group = np.empty(n, np.int64)
        unit_of_group[a_group] = unit_of_a
        n_groups = np.bincount(unit_of_group, minlength=len(units))
        n_links = np.bincount(unit_of_a[left], minlength=len(units))
        # the groups as text: ids joined by commas, sides by a bar, groups by semicolons
        def sides(ids, group):
            return _joined(self.digits.take(ids), np.searchsorted(group, np.arange(n + 1)), ",")
        said = pc.binary_join_element_wise(sides(a_ids, a_group), sides(b_ids, b_group), "|")
        self.groups += _joined(said, np.concatenate([[0], np.cumsum(n_groups)]), ";").to_pylist()
        # each unit's pairs and how often it has them
        pair, unit = a_ids[left] << 32 | b_ids[right], unit_of_a[left]
        order = np.lexsort((pair, unit))
        pair, unit = pair[order], unit[order]
        new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (unit[1:] != unit[:-1])])) if len(pair) else np.empty(0, np.int64)
        held = np.bincount(unit[new], minlength=len(units))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(held)])
        self.pair = np.concatenate([self.pair, pair[new]])
        self.times = np.concatenate([self.times, np.diff(np.append(new, len(pair)))])
        self.whole = np.concatenate([self.whole, whole])
        self.numbers = np.concatenate([self.numbers, np.stack([n_a, n_b, n_groups, n_links], 1)])
        for u in units:
            self.code[u] = len(self.code)

    def units(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the units of all texts (blank in front included) and each text's first."""
        blank = raw == 32
        seen = (raw > 32) & (raw < 127)
        seen[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 128)      # letters U+00C0 to U+00FF
        cut = blank.copy()
        cut[1:] &= seen[:-1]
        cut[offsets[:-1]] = True
        starts = np.flatnonzero(cut)
        arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))])
        found = arr.dictionary_encode()
        distinct = found.dictionary.to_pylist()
        if len(self.code) > CACHE_UNITS:
            self.forget()
        fresh = [u for u in distinct if u not in self.code]
        if fresh:
            self.learn(fresh)
        codes = np.fromiter(map(self.code.__getitem__, distinct), np.int64, len(distinct))
        return codes[found.indices.to_numpy()], np.append(np.searchsorted(starts, offsets[:-1]), len(starts))

    def block(self, texts: pa.Array) -> dict:
        """Numbers of each text and its pairs as places in the block's dictionary."""
        raw, offsets = string_parts(texts)
        code, first = self.units(raw, offsets)
        n, at = len(texts), first[:-1]
        whole = np.logical_and.reduceat(self.whole[code], at) & (np.diff(offsets) > 1)
        numbers = np.add.reduceat(self.numbers[code], at) * whole[:, None]
        digests = [hashlib.sha256(";".join(map(self.groups.__getitem__, code[i:j].tolist())).encode()).hexdigest() if ok else ""
                   for i, j, ok in zip(first[:-1].tolist(), first[1:].tolist(), whole.tolist())]
        # (text, unit) once, then (text, pair) once
        row = np.repeat(np.arange(n), np.diff(first))
        some = whole[row]
        key, times = _summed(row[some] * len(self.code) + code[some], np.ones(int(some.sum()), np.int64))
        row, unit = key // len(self.code), key % len(self.code)
        m = self.first[unit + 1] - self.first[unit]
        link = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(self.first[unit], m)
        pairs, place = np.unique(self.pair[link], return_inverse=True)
        key, times = _summed(np.repeat(row, m) * max(len(pairs), 1) + place, self.times[link] * np.repeat(times, m))
        row, place = key // max(len(pairs), 1), key % max(len(pairs), 1)
        return {"numbers": numbers, "digests": digests, "pairs": pairs, "held": np.bincount(place, minlength=len(pairs)),
                "places": place, "times": times, "ends": np.cumsum(np.bincount(row, minlength=n))}


def _joined(values: pa.Array, first: np.ndarray, between) -> pa.Array:
    """Runs of values joined; run i is ``values[first[i]:first[i + 1]]``."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(first, pa.int32()), values), pa.scalar(between, values.type))


def _summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their values."""
    if not len(key):
        return key, value
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[new], np.add.reduceat(value[order], new)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of little-endian 32-bit numbers."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * 4
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values.astype("<u4")))]).cast(pa.binary())


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_STORED = ", ".join(f"{n} long" for n in _NUMBERS) + ", groups_sha256 string, block long, places binary, times binary, pairs array<long>, held array<long>"


def align(docs: DataFrame, id_col: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups_sha256, block, places, times,
    pairs, held) of every document; a block's ``pairs`` and the number of its
    documents that hold each ride on its first document."""
    a_path, b_path = paths or tokenizer_paths()

    def blocks(batches):
        from pyspark import TaskContext
        task, aligner, number = TaskContext.get().partitionId(), Aligner(a_path, b_path), 0
        for batch in batches:
            column = batch.column(1).fill_null("").cast(pa.large_string())
            spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string()))
            for i, j in slices(string_parts(spaced)[1], SLICE_BYTES):
                got = aligner.block(spaced.slice(i, j - i))
                empty = [None] * (j - i - 1)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), *[pa.array(got["numbers"][:, k]) for k in range(len(_NUMBERS))],
                    pa.array(got["digests"], pa.string()), pa.array(np.full(j - i, task << 32 | number, np.int64)),
                    _binary(got["places"], got["ends"]), _binary(got["times"], got["ends"]),
                    pa.array([got["pairs"].tolist(), *empty], pa.list_(pa.int64())),
                    pa.array([got["held"].tolist(), *empty], pa.list_(pa.int64()))],
                    names=["id", *_NUMBERS, "groups_sha256", "block", "places", "times", "pairs", "held"])
                number += 1

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(frugal(blocks), f"id {kind}, {_STORED}")


def pair_counts(aligned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, place, pair) of the blocks' dictionaries and (pair, count, best):
    how many documents hold a pair, and whether that is its A id's largest."""
    entries = (aligned.where(F.col("pairs").isNotNull()).select("block", F.posexplode(F.arrays_zip("pairs", "held")).alias("place", "e"))
               .select("block", "place", F.col("e.pairs").alias("pair"), F.col("e.held").alias("held")))
    counts = entries.groupBy("pair").agg(F.sum("held").alias("count"))
    largest = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return entries.drop("held"), counts.select("pair", "count", (F.col("count") == largest).alias("best"))


def alignment_query(docs: DataFrame, id_col: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """Each document's numbers; its links weighted by corpus-wide counts."""
    aligned = materialise(align(docs, id_col, text, paths), "aligned")
    entries, counts = pair_counts(aligned)
    answers = entries.join(counts, "pair").select(F.col("block").alias("of"), "place", "count", "best")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, " + ", ".join(f"{n} long" for n in (*_NUMBERS, "n_best", "count_sum")) + ", groups_sha256 string"

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        place = right.column("place").to_numpy()
        count[place] = right.column("count").to_numpy()
        best[place] = right.column("best").to_numpy(zero_copy_only=False)

        def sums(value, at, times, ends):
            total = np.concatenate([[0], np.cumsum(value[at] * times)])
            return np.diff(total[np.concatenate([[0], ends])])

        at, ends = _numbers(left.column("places"))
        times, _ = _numbers(left.column("times"))
        return pa.Table.from_arrays([left.column("id"), *[left.column(n) for n in _NUMBERS],
                                     pa.array(sums(best, at, times, ends)), pa.array(sums(count, at, times, ends)),
                                     left.column("groups_sha256")],
                                    names=[id_col, *_NUMBERS, "n_best", "count_sum", "groups_sha256"])

    rows = aligned.select("id", *_NUMBERS, "groups_sha256", "block", "places", "times")
    return rows.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(weigh, schema)


def _numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All 32-bit numbers of a binary column and the end of each row's."""
    values, ends, base = [], [], 0
    for chunk in column.chunks:
        chunk = chunk.cast(pa.large_binary())
        _, offsets, data = chunk.buffers()
        off = np.frombuffer(offsets, np.int64)[chunk.offset:chunk.offset + len(chunk) + 1]
        raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and data.size else np.empty(0, np.uint8)
        values.append(raw.view("<u4").astype(np.int64))
        ends.append((off[1:] - off[0]) // 4 + base)
        base += (off[-1] - off[0]) // 4
    if not values:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(values), np.concatenate(ends)
