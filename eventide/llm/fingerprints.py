"""Document fingerprints by content-defined chunking.

A gear hash slides over a text's UTF-8 bytes: every byte adds a random number
to the shifted hash, so 32 bytes decide each value.  A chunk may end where the
hash has zeros under a mask; the mask is strict before the normal chunk length
and loose after it, which normalises the lengths.  Each chunk gives a digest;
a fingerprint is the sorted set of (digest, length).  Text that moves keeps
its chunks, so fingerprints resist shifts, and the summed lengths of shared
chunks measure containment: ``likeness`` is the part of the smaller
fingerprint that the other one contains.

The next document in ascending id comes from range buckets: ids are cut at
approximate quantiles, each bucket is sorted by itself, and the first document
of a bucket goes to the bucket before it as well, so texts are shuffled once.

Defined results: a null text counts as empty; an empty text has the empty
fingerprint, like another empty one to 1 and any other to 0; null ids come
first; rows that repeat an id follow each other in the order of a hash of
their texts; a single document is its own next one; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import small_batches, span_hashes

LEAST, NORMAL, MOST = 8, 32, 128       # bytes of a chunk
STRICT, LOOSE = 0xFE000000, 0xF0000000  # masks on the hash's top bits
REACH = 32                              # bytes that decide a hash value
SEED = 99
BUCKET_ROWS = 1024
BUCKETS = 4096                          # at most
SLICE_BYTES = 1 << 20


def _gear() -> np.ndarray:
    table = np.random.default_rng(SEED).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
    table[0] = 0  # so that the gaps between texts leave no trace
    return table


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """h[i] = sum of gear[raw[i - j]] << j for j below REACH, by doubling."""
    h = _gear()[raw]
    width = 1
    while width < REACH:
        older = h[:-width] << np.uint32(width)
        h = h.copy()
        h[width:] += older
        width *= 2
    return h


def _cuts(start: int, end: int, strict: list[int], loose: list[int]) -> list[int]:
    """Chunk ends of the text at [start, end)."""
    out, s, n, m = [], start, len(strict), len(loose)
    a = b = 0
    while end - s > LEAST:
        a = bisect_left(strict, s + LEAST, a)
        if a < n and strict[a] < min(end, s + NORMAL):
            s = strict[a]
        else:
            b = bisect_left(loose, s + NORMAL, b)
            stop = min(end, s + MOST)
            s = loose[b] if b < m and loose[b] < stop else stop
        out.append(s)
    if s < end:
        out.append(end)
    return out


def chunk_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For each text its sorted chunk set: digest << 16 | length, as uint64."""
    gap = b"\0" * REACH
    raw = np.frombuffer(gap.join(texts) + gap, np.uint8)
    h = gear_hashes(raw)
    # a chunk ends after the byte whose hash fits
    loose = np.flatnonzero((h & np.uint32(LOOSE)) == 0) + 1
    strict = loose[(h[loose - 1] & np.uint32(STRICT)) == 0]
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + REACH)[:-1])) if len(texts) else np.empty(0, np.int64)
    ends = starts + sizes
    lo, hi = np.searchsorted(loose, starts, "right"), np.searchsorted(loose, ends)
    slo, shi = np.searchsorted(strict, starts, "right"), np.searchsorted(strict, ends)
    loose, strict = loose.tolist(), strict.tolist()
    cuts = [_cuts(int(s), int(e), strict[c:d], loose[a:b]) for s, e, a, b, c, d in zip(starts, ends, lo, hi, slo, shi)]
    counts = np.array([len(c) for c in cuts], np.int64)
    stop = np.fromiter((x for c in cuts for x in c), np.int64, int(counts.sum()))
    begin = np.empty_like(stop)
    begin[1:] = stop[:-1]
    first = np.cumsum(counts) - counts
    begin[first[counts > 0]] = starts[counts > 0]
    packed = (span_hashes(raw, begin, stop) & ~np.uint64(0xFFFF)) | (stop - begin).astype(np.uint64)
    return [np.unique(packed[f:f + c]) for f, c in zip(first, counts)]


def weight(chunks: np.ndarray) -> int:
    return int((chunks & np.uint64(0xFFFF)).sum())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared length over the smaller fingerprint's length, 0 to 1."""
    least = min(weight(a), weight(b))
    if not least:
        return 1.0 if len(a) == len(b) else 0.0
    return min(1.0, weight(np.intersect1d(a, b, assume_unique=True)) / least)


def as_text(chunks: np.ndarray) -> str:
    """16 hex digits per chunk: 12 of the digest, 4 of the length."""
    return chunks.astype(">u8").tobytes().hex()


def fingerprint(texts: list[str | None]) -> list[np.ndarray]:
    """Chunk sets of whole texts, some at a time."""
    out, held, size = [], [], 0
    for t in texts:
        b = (t or "").encode()
        held.append(b)
        size += len(b)
        if size >= SLICE_BYTES:
            out += chunk_sets(held)
            held, size = [], 0
    return out + (chunk_sets(held) if held else [])


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the head of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def in_order(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(bucket, tail, id, t): sorted buckets of rising ids, each followed by
    the first document of the next one (``tail``)."""
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    n = ids.count()
    k = max(1, min(BUCKETS, n // BUCKET_ROWS))
    points = ids.agg(F.percentile_approx("id", [i / k for i in range(1, k)], 10 * BUCKETS).alias("p")).first()["p"] if k > 1 else []
    edges = np.unique(np.array(points or [], np.int64))

    @F.pandas_udf("int")
    def bucket_of(id_: pd.Series) -> pd.Series:
        known = id_.notna()
        out = np.zeros(len(id_), np.int32)
        out[known] = np.searchsorted(edges, id_[known].to_numpy(np.int64), "right")
        return pd.Series(out)

    # BUCKETS rows at most; a null id is the least
    heads = (ids.withColumn("b", bucket_of("id")).groupBy("b").agg(F.min(F.struct("id")).alias("m"))
             .select("b", "m.id").orderBy("b").collect())
    before = {h["id"]: heads[i - 1]["b"] for i, h in enumerate(heads)}
    null_to = before.get(None)
    keys = np.array(sorted(x for x in before if x is not None), np.int64)
    goes = np.array([before[x] for x in keys.tolist()], np.int32)

    @F.pandas_udf("array<int>")
    def places(id_: pd.Series) -> pd.Series:
        known = id_.notna().to_numpy()
        own, also = np.zeros(len(id_), np.int32), np.full(len(id_), -1, np.int32)
        v = id_[known].to_numpy(np.int64)
        own[known] = np.searchsorted(edges, v, "right")
        if len(keys):
            at = np.minimum(np.searchsorted(keys, v), len(keys) - 1)
            also[known] = np.where(keys[at] == v, goes[at], -1)
        if null_to is not None:
            also[~known] = null_to
        return pd.Series([[a] if b < 0 else [a, b] for a, b in zip(own.tolist(), also.tolist())])

    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
            .withColumn("places", places("id"))
            .select(F.posexplode("places").alias("tail", "bucket"), "id", "t"))
    return (rows.select("bucket", "tail", "id", F.xxhash64("t").alias("h"), "t")
            .repartition("bucket").sortWithinPartitions("bucket", "tail", "id", "h"))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every row of ``docs``."""

    def described(rows: list[tuple[int, str]], following: list[str]):
        """``following[i]`` is the text after ``rows[i]``; texts are in order."""
        texts = [t for _, t in rows]
        new = [edited(t, f) for t, f in zip(texts, following)]
        own = fingerprint([*texts, following[-1]])
        # a row's follower is the next row, but for the last one
        changed = fingerprint(new)
        return pa.RecordBatch.from_arrays([
            pa.array([i for i, _ in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in new]),
            pa.array([as_text(x) for x in own[:-1]]), pa.array([as_text(x) for x in changed]),
            pa.array([likeness(a, b) for a, b in zip(own, changed)]),
            pa.array([likeness(a, b) for a, b in zip(own, own[1:])])],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches):
        held: list[tuple[int, str]] = []  # rows in order whose last one still lacks its follower
        bucket, closed, size = None, False, 0
        for batch in batches:
            for b, tail, i, t in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4))):
                if b != bucket:
                    bucket, closed, held, size = b, False, [], 0
                if closed:
                    continue  # only the first tail row follows the bucket's last document
                if held and (tail or size >= SLICE_BYTES):
                    yield described(held, [x for _, x in held[1:]] + [t])
                    held, size = [], 0
                if tail:
                    closed = True
                else:
                    held.append((i, t))
                    size += len(t)

    ordered = in_order(small_batches(docs), id_col, text)
    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double")
