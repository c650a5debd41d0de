"""Quality classifier: random-indexing word vectors and a small network.

1. Random indexing over all documents.  A token (a run of letters, digits and
   non-ASCII characters, or a run of signs) falls by its hash into one of
   ``BUCKETS`` words.  Every word has a sparse random index vector; its word
   vector is the sum of the index vectors of its neighbours (``WINDOW`` to
   each side) over the whole corpus.  Tasks add up their own documents with
   numpy; Spark sums the ``BUCKETS`` partial rows of each task.
2. A document is pooled from its tokens' unit word vectors: their mean, their
   spread, the likeness of neighbouring tokens, and the share of tokens that
   repeat the one before.
3. A two-layer network (numpy, Adam) is trained on a bounded sample of
   labelled documents; a held-back part of the sample fits the temperature
   that calibrates its probabilities.

Defined results: null and empty texts pool to zeros and get the network's
value there; equal texts score alike; repeated rows are kept; other columns
are kept by ``score_quality`` unless named like its own (those are replaced);
an empty table gives an empty result; without both labels in the sample every
score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import frugal, held_out, labelled_sample, segments, slices, small_batches, span_hashes, string_parts

BUCKETS = 8192
DIM = 32
NONZERO = 4            # entries of an index vector, half of them negative
WINDOW = 2
SLICE_BYTES = 1 << 20  # of text whose neighbours a task counts at once
POOL_BYTES = 1 << 18   # of text pooled at once: DIM numbers for each token
SAMPLE_ROWS = 16_000   # labelled documents the network is trained on, at most
HIDDEN = 24
EPOCHS = 400
SEED = 7
THRESHOLD = 0.7
FEATURES = 2 * DIM + 3


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places (BUCKETS, NONZERO) and signs (NONZERO,) of the index vectors."""
    rng = np.random.default_rng(SEED)
    places = np.argsort(rng.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
    return places, np.where(np.arange(NONZERO) % 2, -1.0, 1.0)


def _byte_classes() -> np.ndarray:
    c = np.zeros(256, np.uint8)  # 0 space and control, 1 word, 2 sign
    c[33:127] = 2
    for a, b in (("0", "9"), ("A", "Z"), ("a", "z")):
        c[ord(a):ord(b) + 1] = 1
    c[128:] = 1
    return c


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and hash of every token, and each row's first token (n + 1)."""
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    cls = _byte_classes()[raw]
    edge = np.empty(len(raw), bool)
    edge[0] = True
    np.not_equal(cls[1:], cls[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < len(raw)]] = True
    at = np.flatnonzero(edge)
    ends = np.append(at[1:], len(raw))
    word = cls[at] > 0
    at, ends = at[word], ends[word]
    h = span_hashes(raw, at, ends)
    return (h % np.uint64(BUCKETS)).astype(np.int64), h, np.searchsorted(at, offsets)


def _context_sums(batches):
    """One row per word with the sums of its neighbours' index vectors."""
    places, signs = index_vectors()
    total = np.zeros(BUCKETS * DIM)
    for batch in batches:
        raw, offsets = string_parts(batch.column("text"))
        offsets, _ = segments(raw, offsets, SLICE_BYTES)
        for i, j in slices(offsets, SLICE_BYTES):
            bucket, _, first = tokens(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            row = np.repeat(np.arange(j - i), np.diff(first))
            for gap in range(1, WINDOW + 1):
                same = row[gap:] == row[:-gap]
                left, right = bucket[:-gap][same] * DIM, bucket[gap:][same] * DIM
                for k in range(NONZERO):
                    p = places[:, k]
                    total += signs[k] * np.bincount(left + p[right // DIM], minlength=BUCKETS * DIM)
                    total += signs[k] * np.bincount(right + p[left // DIM], minlength=BUCKETS * DIM)
    rows = total.reshape(BUCKETS, DIM).astype(np.int64)
    used = np.flatnonzero(rows.any(axis=1))
    if len(used):
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(rows[used, k]) for k in range(DIM))],
                                         names=["word", *(f"d{k}" for k in range(DIM))])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit word vectors (BUCKETS, DIM) from all documents."""
    dims = [f"d{k}" for k in range(DIM)]
    sums = (docs.select(F.col(text).alias("text")).mapInArrow(frugal(_context_sums), "word long, " + ", ".join(f"{d} long" for d in dims))
            .groupBy("word").agg(*[F.sum(d).alias(d) for d in dims]))
    rows = sums.toPandas()  # BUCKETS rows at most
    out = np.zeros((BUCKETS, DIM))
    if len(rows):
        out[rows["word"].to_numpy(int)] = rows[dims].to_numpy(float)
    out = np.sign(out) * np.sqrt(np.abs(out))  # frequent neighbours weigh less
    out -= out[out.any(axis=1)].mean(axis=0) if out.any() else 0
    norm = np.sqrt((out * out).sum(1))
    return np.divide(out, norm[:, None], out=np.zeros_like(out), where=norm[:, None] > 0).astype(np.float32)


def pooled(raw: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Feature rows (n, FEATURES) of the documents in one buffer."""
    n = len(offsets) - 1
    cuts, row_of = segments(raw, offsets, POOL_BYTES)  # sums of a long text's pieces add up
    count, total, square = np.zeros(n), np.zeros((n, DIM)), np.zeros((n, DIM))
    near, again, steps = np.zeros(n), np.zeros(n), np.zeros(n)
    for i, j in slices(cuts, POOL_BYTES):
        bucket, h, first = tokens(raw[cuts[i]:cuts[j]], cuts[i:j + 1] - cuts[i])
        some = np.flatnonzero(np.diff(first))
        if not len(some):
            continue
        v, at, rows = vectors[bucket], first[:-1][some], row_of[i + some]
        likeness, repeat = np.zeros(len(bucket)), np.zeros(len(bucket))
        likeness[1:] = np.einsum("ij,ij->i", v[1:], v[:-1])
        repeat[1:] = h[1:] == h[:-1]
        likeness[at], repeat[at] = 0, 0
        np.add.at(count, rows, np.diff(first)[some])
        np.add.at(steps, rows, np.diff(first)[some] - 1)
        np.add.at(total, rows, np.add.reduceat(v, at, axis=0, dtype=np.float64))
        np.add.at(square, rows, np.add.reduceat(v * v, at, axis=0, dtype=np.float64))
        np.add.at(near, rows, np.add.reduceat(likeness, at))
        np.add.at(again, rows, np.add.reduceat(repeat, at))
    c = np.maximum(count, 1)[:, None]
    mean, steps = total / c, np.maximum(steps, 1)
    spread = np.sqrt(np.maximum(0, square / c - mean * mean))
    few = np.where(count > 0, np.minimum(1.0, 4.0 / np.maximum(count, 1)), 0.0)
    return np.column_stack([mean, spread, near / steps, again / steps, few])


def _forward(net: dict, x: np.ndarray) -> np.ndarray:
    hidden = np.tanh(((x - net["mean"]) / net["scale"]) @ net["w1"] + net["b1"])
    return hidden @ net["w2"] + net["b2"]


def train(x: np.ndarray, y: np.ndarray) -> dict:
    """A two-layer network with a temperature fitted on every fifth row."""
    rng = np.random.default_rng(SEED)
    net = {"mean": x.mean(0), "scale": x.std(0) + 1e-3, "temperature": 1.0,
           "w1": rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), "b1": np.zeros(HIDDEN),
           "w2": rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), "b2": 0.0}
    check = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[~check])) < 2 or len(np.unique(y[check])) < 2:
        check[:] = False
    z, t = ((x - net["mean"]) / net["scale"])[~check], y[~check]
    weight = np.where(t == 1, 0.5 / max(t.mean(), 1e-9), 0.5 / max(1 - t.mean(), 1e-9))
    weight = np.sqrt(weight)  # between the classes' own shares and equal shares
    names = ("w1", "b1", "w2", "b2")
    m, v = ({k: np.zeros_like(np.asarray(net[k], float)) for k in names} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(t))
        for part in np.array_split(order, max(1, len(t) // 4096)):
            h = np.tanh(z[part] @ net["w1"] + net["b1"])
            p = 1 / (1 + np.exp(-np.clip(h @ net["w2"] + net["b2"], -40, 40)))
            e = (p - t[part]) * weight[part] / len(part)
            back = np.outer(e, net["w2"]) * (1 - h * h)
            grads = {"w2": h.T @ e + 1e-4 * net["w2"], "b2": e.sum(), "w1": z[part].T @ back + 1e-4 * net["w1"], "b1": back.sum(0)}
            step += 1
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * grads[k]
                v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
                net[k] = net[k] - 0.01 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    if check.any():
        logits, truth = _forward(net, x[check]), y[check]
        def loss(temperature):
            p = 1 / (1 + np.exp(-np.clip(logits / temperature, -40, 40)))
            return -np.mean(truth * np.log(p + 1e-12) + (1 - truth) * np.log(1 - p + 1e-12))
        net["temperature"] = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return net


def fit_quality(docs: DataFrame, labels: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> dict:
    """Word vectors from all documents, the network from a bounded sample."""
    vectors = word_vectors(small_batches(docs), text)
    sample = labelled_sample(docs, labels, "quality", text, sample_rows)

    def described(batches):
        for batch in batches:
            x = pooled(*string_parts(batch.column("text")), vectors)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(list(x), pa.list_(pa.float64()))],
                                             names=["doc_id", "y", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (sample.select("doc_id", "y", "text")
            .mapInArrow(frugal(described), f"doc_id {kind}, y int, x array<double>").toPandas())
    rows = rows[rows["y"].isin((0, 1))].sort_values(["doc_id", "y"], kind="stable")
    y = rows["y"].to_numpy(float)
    if len(np.unique(y)) < 2:
        return {"vectors": vectors, "net": None, "prior": float(y.mean()) if len(y) else 0.5}
    return {"vectors": vectors, "net": train(np.stack(rows["x"].to_numpy()), y), "prior": float(y.mean())}


def probabilities(model: dict, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if model["net"] is None:
        return np.full(len(offsets) - 1, model["prior"])
    logits = _forward(model["net"], pooled(raw, offsets, model["vectors"]))
    return 1 / (1 + np.exp(-np.clip(logits / model["net"]["temperature"], -60, 60)))


def score_quality(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (label 1 likelier when higher) and ``predicted``."""
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = kept.index(text)

    def scored(batches):
        for batch in batches:
            p = probabilities(shared.value, *string_parts(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                                             names=[*kept, "score", "predicted"])

    schema = docs.select(*kept).schema.add("score", "double").add("predicted", "integer")
    return small_batches(docs).select(*kept).mapInArrow(frugal(scored), schema)


def quality_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit_quality(docs, labels)
    # ids alone travel back from the tasks, not the texts
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for batch in batches:
            p = probabilities(shared.value, *string_parts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text").mapInArrow(frugal(scored), f"doc_id {kind}, score double, predicted int")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"))
