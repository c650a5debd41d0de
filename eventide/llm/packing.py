"""Packing by cutting-stock column generation.

Every document is tokenized and closed with ``END``; its ids are cut into
pieces of ``LENGTH`` and one rest.  Whole pieces are sequences by themselves.
The rests are the items of a cutting-stock problem whose demands are the
histogram of their lengths, in classes ``UNIT`` tokens wide:

* items of one short length go in bundles of eight or four, which fill whole
  units without rounding, so short documents pack as tightly as long ones;
* a linear program over patterns (how many items of each class share one
  sequence) is solved by the simplex method, its columns generated by a
  knapsack dynamic program over the dual prices until no pattern prices out;
* patterns are used floor(x) times; what is left of the demands, at most a few
  items for each class, is packed best-fit decreasing;
* the documents of a class are ranked, and rank ranges of a class belong to
  patterns, so each rest finds its sequence by one lookup.

The driver sees the histogram and the patterns only (classes, not rows).
Tokenizing keeps, in each worker, the ids of the word pieces met so far,
known by a 64-bit hash; texts are cut where the tokenizer itself always cuts
(at blanks, between ASCII letters, digits and signs), so only new pieces go
through it.

Defined results: null and empty texts are the single id ``END``; strings of
special tokens in a text are those tokens, as the tokenizer reads them by
itself; repeated rows are packed each;
null ids are kept; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.llm.common import frugal, materialise, ranked, segments, slices, small_batches, span_hashes, string_parts

LENGTH = 2048
END = 1
UNIT = 8
SLICE_BYTES = 1 << 20
CACHE_PIECES = 1_500_000    # word pieces a worker remembers before it starts anew
BUCKET_ROWS = 100_000
GAP = 1e-3                  # share of sequences by which the linear program may miss its bound
_END_BYTES = np.array([END], "<u4").tobytes()


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# --- tokens ---------------------------------------------------------------------

def _byte_classes() -> np.ndarray:
    c = np.full(256, 4, np.uint8)          # joins both sides: non-ASCII, apostrophe, control
    c[[32, 9, 10, 13]] = 0                  # blank
    c[33:127] = 3                           # sign
    c[ord("'")] = 4
    for a, b, k in (("A", "Z", 1), ("a", "z", 1), ("0", "9", 2)):
        c[ord(a):ord(b) + 1] = k
    return c


def word_pieces(raw: np.ndarray, offsets: np.ndarray, special: list[bytes] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches that the tokenizer never joins; strings of
    special tokens are stretches of their own."""
    cls = _byte_classes()[raw]
    cut = np.empty(len(raw), bool)
    cut[0] = True
    a, b = cls[:-1], cls[1:]
    cut[1:] = (a != b) & (a < 4) & (b < 4) | (a == 0) | (b == 0) | (a == 2) & (b == 2)
    cut[offsets[:-1][offsets[:-1] < len(raw)]] = True
    text = raw.tobytes() if len(special) else b""
    for m in re.finditer(b"|".join(map(re.escape, special)), text) if len(special) else ():
        a, b = m.span()
        if np.searchsorted(offsets, a, "right") == np.searchsorted(offsets, b - 1, "right"):  # within one text
            cut[a:b + 1] = False
            cut[a] = True
            cut[b:b + 1] = True
    at = np.flatnonzero(cut)
    ends = np.append(at[1:], len(raw))
    some = cls[at] > 0
    return at[some], ends[some]


class Tokens:
    """The tokenizer with the ids of the word pieces met so far."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self):
        self.known, self.first, self.count = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0

    def _learn(self, hashes: np.ndarray, words: list[str]):
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        count = np.array([len(x) for x in got], np.int64)
        need = self.used + int(count.sum())
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.empty(max(need, 2 * len(self.ids)) - self.used, np.uint32)])
        self.ids[self.used:need] = np.fromiter((i for x in got for i in x), np.uint32, need - self.used)
        first = self.used + np.cumsum(count) - count
        self.used = need
        order = np.argsort(hashes)
        at = np.searchsorted(self.known, hashes[order])
        self.known = np.insert(self.known, at, hashes[order])
        self.first = np.insert(self.first, at, first[order])
        self.count = np.insert(self.count, at, count[order])

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows in one buffer, and each row's first (n + 1)."""
        if not len(raw):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts, ends = word_pieces(raw, offsets, self.special)
        # lower case where the tokenizer would do just that (no mark follows)
        upper = (raw >= 65) & (raw <= 90)
        upper[:-1] &= raw[1:] < 128
        h = span_hashes(raw + (upper.astype(np.uint8) << 5), starts, ends)
        code, unique = pd.factorize(h)
        if len(self.known) > CACHE_PIECES:
            self.forget()
        at = np.searchsorted(self.known, unique)
        new = np.ones(len(unique), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != unique[inside]
        if new.any():
            seen = np.empty(len(unique), np.int64)
            seen[code[::-1]] = np.arange(len(code))[::-1]
            text = raw.tobytes()
            self._learn(unique[new], [text[starts[i]:ends[i]].decode("utf-8", "replace") for i in seen[new]])
            at = np.searchsorted(self.known, unique)
        first, count = self.first[at][code], self.count[at][code]
        total = np.concatenate(([0], np.cumsum(count)))
        ids = self.ids[np.repeat(first - total[:-1], count) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, offsets)]


def _pieces(row_ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces of one document's ids and END."""
    n, out = len(row_ids) + 1, []
    for start in range(0, n, LENGTH):
        stop = min(n, start + LENGTH)
        crc = zlib.crc32(row_ids[start:min(stop, n - 1)])
        out.append((start, stop - start, zlib.crc32(_END_BYTES, crc) if stop == n else crc))
    return out


def document_pieces(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): the pieces of all documents."""
    state = docs.sparkSession.sparkContext.broadcast({"path": path or tokenizer_path()})

    def run(batches):
        held = state.value  # one dictionary for each worker process
        if "tokens" not in held:
            held["tokens"] = Tokens(held["path"])
        tokens = held["tokens"]
        for batch in batches:
            raw, offsets = string_parts(batch.column(1))
            cuts, row_of = segments(raw, offsets, SLICE_BYTES)
            rows, values, part = [], [], []
            for i, j in slices(cuts, SLICE_BYTES):
                ids, first = tokens.encode(raw[cuts[i]:cuts[j]], cuts[i:j + 1] - cuts[i])
                for k in range(i, j):
                    part.append(ids[first[k - i]:first[k - i + 1]])
                    if k + 1 < len(row_of) and row_of[k + 1] == row_of[k]:
                        continue  # the text goes on
                    whole = part[0] if len(part) == 1 else np.concatenate(part)
                    part = []
                    for piece in _pieces(np.ascontiguousarray(whole)):
                        rows.append(row_of[k])
                        values.append((*piece, len(whole) + 1))
            v = np.array(values, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.array(rows, np.int64))), *(pa.array(v[:, k]) for k in range(4))],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(frugal(run), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"))


# --- cutting stock ---------------------------------------------------------------

def _knapsack(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The dearest pattern that fits: its price and how many of each size."""
    value, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for w in range(1, room + 1):
        value[w], fits = value[w - 1], np.searchsorted(sizes, w, "right")
        if fits:
            v = value[w - sizes[:fits]] + prices[:fits]
            k = int(v.argmax())
            if v[k] > value[w] + 1e-12:
                value[w], choice[w] = v[k], k
    pattern, w = np.zeros(len(sizes)), room
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            pattern[choice[w]] += 1
            w -= sizes[choice[w]]
    return float(value[room]), pattern


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP, rounds: int = 6000) -> tuple[np.ndarray, np.ndarray]:
    """Columns (classes, patterns) and use x >= 0 of the linear program
    "fewest patterns that cover the demand", by column generation."""
    m = len(sizes)
    columns = np.diag(room // sizes).astype(float)
    inverse, x = np.diag(1.0 / np.diag(columns)), demand / np.diag(columns)
    cost = np.ones(m)  # of the basis columns: 1 a pattern, 0 a surplus
    for _ in range(rounds):
        prices = cost @ inverse
        k = int(prices.argmin())
        if prices[k] < -1e-9:  # a surplus column pays: this class is covered too often
            enter, price = np.zeros(m), 0.0
            enter[k] = -1.0
        else:
            value, enter = _knapsack(np.maximum(prices, 0), sizes, room)
            if value <= 1 + 1e-9 or (1 - 1 / value) < gap:  # Farley's bound
                break
            price = 1.0
        step = inverse @ enter
        rising = step > 1e-10
        if not rising.any():
            break
        ratio = np.full(m, np.inf)
        ratio[rising] = np.maximum(x[rising], 0) / step[rising]
        out = int(ratio.argmin())
        x -= ratio[out] * step
        x[out] = ratio[out]
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        columns[:, out], cost[out] = enter, price
    used = cost > 0
    return columns[:, used], np.maximum(x[used], 0)


def plan(demand: dict[int, int], room: int = LENGTH // UNIT) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Where the items of each class go: rows (class, first rank, rank after
    the last, first sequence, items of the class in one sequence), and the
    number of sequences.  ``demand`` counts the items of each class."""
    classes = sorted(c for c, n in demand.items() if n)
    if not classes:
        return [], 0
    sizes, left = np.array(classes), np.array([demand[c] for c in classes], np.int64)
    uses: list[tuple[np.ndarray, int]] = []
    columns, x = solve_patterns(sizes, left.astype(float), room)
    for pattern, times in sorted(zip(columns.T.astype(np.int64).tolist(), x), key=lambda p: (-p[1], p[0])):
        a = np.array(pattern)
        times = int(times + 1e-7)
        if times and a.any():
            times = min(times, int((left[a > 0] // a[a > 0]).min()))
        if times and a.any():
            uses.append((a, times))
            left = left - a * times
    # the rest of the demands: best-fit decreasing, one sequence after another
    while left.any():
        a, space = np.zeros(len(sizes), np.int64), room
        while True:
            fits = np.flatnonzero((left - a > 0) & (sizes <= space))
            if not len(fits):
                break
            k = fits[-1]
            a[k] += 1
            space -= sizes[k]
        times = max(1, int((left[a > 0] // a[a > 0]).min()))
        uses.append((a, times))
        left = left - a * times
    rows, sequence, rank = [], 0, {c: 0 for c in classes}
    for a, times in uses:
        for k in np.flatnonzero(a):
            c, n = classes[k], int(a[k]) * times
            rows.append((c, rank[c], rank[c] + n, sequence, int(a[k])))
            rank[c] += n
        sequence += times
    return rows, sequence


def bundle(length: int) -> int:
    """Items of one length that go together: eight (four) of a short length
    fill whole units, where each by itself would be rounded up."""
    return 8 if length < LENGTH // 16 else 4 if length < LENGTH // 8 else 1


def bundles(counts: dict[int, int]) -> tuple[list[tuple[int, ...]], dict[int, int]]:
    """For each length (length, items of a bundle, items in whole bundles, the
    bundles' class and first rank, the class and first rank of the items left
    over), and the demand of all classes."""
    rows, demand = [], {}
    for length, n in sorted(counts.items()):
        m = bundle(length)
        row = [length, m, n // m * m]
        for size, items in ((m * length, n // m), (length, n % m)):
            c = -(-size // UNIT)
            row += [c, demand.get(c, 0)]
            demand[c] = demand.get(c, 0) + items
        rows.append(tuple(row))
    return rows, demand


def _table(spark, rows: list[tuple], names: str) -> DataFrame:
    columns = names.split()
    return spark.createDataFrame(pd.DataFrame(rows, columns=columns).astype("int64"), ", ".join(f"{c} long" for c in columns))


def pack(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id and offset."""
    spark = docs.sparkSession
    pieces = materialise(document_pieces(docs, path, id_col, text), "pack-pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # LENGTH rows at most
    total, whole = sum(counts.values()), counts.pop(LENGTH, 0)
    lengths, demand = bundles(counts)
    rows, sequences = plan(demand)
    if whole:  # whole pieces: one in each sequence
        lengths.append((LENGTH, 1, whole, 0, 0, 0, whole))
        rows.append((0, 0, whole, sequences, 1))
    known = _table(spark, lengths, "of m full class1 first1 class2 first2")
    table = _table(spark, rows, "c low high base each")
    buckets = max(16, total // BUCKET_ROWS)
    numbered = ranked(pieces, ["length"], [F.col("doc_id"), F.col("start"), F.col("ids_crc32")],
                      F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)), "nth")
    together = F.col("nth") < F.col("full")
    classed = (numbered.join(F.broadcast(known), F.col("length") == F.col("of"))  # LENGTH rows at most
               .withColumn("size_class", F.when(together, F.col("class1")).otherwise(F.col("class2")))
               .withColumn("rank", F.when(together, F.col("first1") + F.floor(F.col("nth") / F.col("m")))
                           .otherwise(F.col("first2") + F.col("nth") - F.col("full")))
               .withColumn("inner", F.when(together, F.col("nth") % F.col("m")).otherwise(F.lit(0))))
    hit = (F.col("size_class") == F.col("c")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = (classed.join(F.broadcast(table), hit)  # bounded: patterns by their classes
              .withColumn("sequence_id", (F.col("base") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))).cast("long")))
    ahead = Window.partitionBy("sequence_id").orderBy("size_class", "rank", "inner").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("long").alias("offset"))
