"""SimHash near-duplicates by a forest of vantage-point trees.

A text's 64-bit fingerprint has a bit set where over half of its word
shingles' hashes have it.  Fingerprints that differ in at most ``DISTANCE``
bits are linked; a group is what links reach.

Vantage-point trees over all 64 bits prune nothing here: distances between
unrelated fingerprints crowd around 32 with a spread of 4, so a ball of radius
4 crosses nearly every boundary.  The bits are therefore cut into ``PARTS``
parts, and there is one tree for each part's Hamming distance.  Of two linked
fingerprints some part differs in at most floor(DISTANCE / PARTS) bits, so a
search of that small radius in every part's tree finds every link, and there
the triangle bounds do prune.

A tree is built from a bounded sample: a node holds a vantage point and a
radius mu; fingerprints no farther than mu go to the near shard, the others to
the far one, and those of the near shard within the search radius of the
boundary go to the far shard too.  By the triangle inequality two fingerprints
within the radius then meet in a leaf.  All distinct fingerprints are routed
to their leaves by Spark, and exact 64-bit distances are computed inside each
leaf.  A leaf expected to hold more than ``LEAF_ROWS`` is cut into groups that
meet pairwise.  A leaf returns a spanning set of its links, never all pairs;
components come from rounds of contraction by joins.

Defined results: null texts count as empty; empty texts have fingerprint 0,
linked like any other; equal texts and repeated rows share a fingerprint; the
component of documents that all have null ids is null; an empty table gives
an empty result; extra columns are ignored (``keep_one`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import fresh, frugal, materialise, small_batches

SHINGLE = 4
DISTANCE = 4
PARTS = 3
SAMPLE = 65_536        # distinct fingerprints the trees are built from, about (all of fewer)
LEAF_SAMPLE = 32       # of them in a leaf
LEAF_ROWS = 8_192      # expected fingerprints of a leaf that meet in one place
HASH_SEED = 42
SLICE = 65_536         # shingles counted at once


# --- fingerprints -------------------------------------------------------------

def _hashes(text: str | None, shingle: int) -> np.ndarray:
    words = (text or "").encode().lower().split()  # bytes: A-Z and 0x20, 0x09-0x0D alone
    if not words:
        return np.empty(0, np.uint64)
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    h = xxhash.xxh64_intdigest
    pairs = zip(starts[:n].tolist(), ends[len(words) - n:].tolist())
    return np.fromiter((h(joined[s:e], HASH_SEED) for s, e in pairs), np.uint64, n)


def _fold_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """Counts (n, 64) of set bits for some documents' hashes."""
    out = np.zeros((len(hashes), 64), np.int64)
    full = [i for i, h in enumerate(hashes) if len(h)]
    if full:
        bits = np.unpackbits(np.concatenate([hashes[i] for i in full]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at = np.cumsum([0, *(len(hashes[i]) for i in full[:-1])])
        out[full] = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    return out


def fingerprints_of(texts, shingle: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprints of texts, whole and of any length."""
    counts, sizes, waiting, held = [], [], [], 0

    def flush():
        nonlocal waiting, held
        if waiting:
            counts.append(_fold_bits(waiting))
            sizes.extend(len(h) for h in waiting)
        waiting, held = [], 0

    for text in texts:
        h = _hashes(text, shingle)
        if len(h) > SLICE:
            flush()
            counts.append(sum(_fold_bits([h[i:i + SLICE]]) for i in range(0, len(h), SLICE)))
            sizes.append(len(h))
            continue
        waiting.append(h)
        held += len(h)
        if held >= SLICE:
            flush()
    flush()
    if not counts:
        return np.empty(0, np.uint64)
    bits = np.concatenate(counts) * 2 > np.array(sizes)[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def add_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """The other columns of ``docs`` and the fingerprint as a (signed) long; the text stays behind."""
    kept = [c for c in docs.columns if c != text]

    def run(batches):
        for batch in batches:
            f = fingerprints_of(batch.column(0).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(f.view(np.int64))], names=[*kept, out])

    return small_batches(docs).select(F.col(text).cast("string"), *kept).mapInArrow(frugal(run), docs.select(*kept).schema.add(out, "long"))


# --- vantage-point trees --------------------------------------------------------

def part_masks(parts: int = PARTS) -> list[int]:
    edges = [64 * i // parts for i in range(parts + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def build_tree(sample: np.ndarray, mask: int, radius: int, leaf: int = LEAF_SAMPLE) -> dict[str, np.ndarray]:
    """Arrays of a tree's nodes, built level by level: vantage point, mu, the
    two children (0: none, a leaf) and the sample's count there."""
    rng = np.random.default_rng(mask % (1 << 32))
    vantage, mu, near, far, count = [0], [0], [0], [0], [len(sample)]
    f = sample & np.uint64(mask)
    point, node = np.arange(len(f)), np.zeros(len(f), np.int64)
    tries, width = 0, bin(mask).count("1") + 1
    while len(point):
        order = np.argsort(node, kind="stable")
        point, node = point[order], node[order]
        ids, first, size = np.unique(node, return_index=True, return_counts=True)
        seat = np.repeat(np.arange(len(ids)), size)
        best = None
        for _ in range(3):  # of three vantage points the one that separates best
            v = f[point[first + (rng.random(len(ids)) * size).astype(np.int64)]]
            d = np.bitwise_count(f[point] ^ v[seat]).astype(np.int64)
            below = np.cumsum(np.bincount(seat * width + d, minlength=len(ids) * width).reshape(-1, width), axis=1)
            to_near = below.astype(float)
            to_far = size[:, None] - np.pad(below, ((0, 0), (radius, 0)))[:, :width]
            to_far = np.where(to_near >= size[:, None], size[:, None], to_far)
            cost = to_near ** 2 + to_far ** 2
            m = cost.argmin(axis=1)
            low = cost[np.arange(len(ids)), m]
            if best is None:
                best = [low, v, m, d]
            else:
                better = low < best[0]
                best = [np.where(better, low, best[0]), np.where(better, v, best[1]), np.where(better, m, best[2]),
                        np.where(better[seat], d, best[3])]
        low, v, m, d = best
        split = (size > leaf) & (low < 0.8 * size.astype(float) ** 2)  # else the copies outweigh the pruning
        kids = np.zeros(len(ids), np.int64)
        kids[split] = len(vantage) + 2 * np.arange(split.sum())
        for i in np.flatnonzero(split):
            k = ids[i]
            vantage[k], mu[k], near[k], far[k] = int(v[i]), int(m[i]), int(kids[i]), int(kids[i]) + 1
        grow = 2 * int(split.sum())
        for column in (vantage, mu, near, far, count):
            column.extend([0] * grow)
        go = split[seat]
        point, d, m, kid = point[go], d[go], m[seat][go], kids[seat][go]
        a, b = d <= m, d > m - radius
        point = np.concatenate([point[a], point[b]])
        node = np.concatenate([kid[a], kid[b] + 1])
        for k, n in zip(*np.unique(node, return_counts=True)):
            count[k] = int(n)
        tries += 1
        if tries > 64:
            break
    return {"vantage": np.array(vantage, np.uint64), "mu": np.array(mu), "near": np.array(near), "far": np.array(far),
            "count": np.array(count), "mask": np.uint64(mask), "radius": radius}


def route(tree: dict[str, np.ndarray], f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, leaf) of every leaf that each fingerprint belongs to."""
    point, node = np.arange(len(f)), np.zeros(len(f), np.int64)
    masked, out = f & tree["mask"], []
    while len(point):
        at_leaf = tree["near"][node] == 0
        out.append((point[at_leaf], node[at_leaf]))
        point, node = point[~at_leaf], node[~at_leaf]
        d = np.bitwise_count(masked[point] ^ tree["vantage"][node]).astype(np.int64)
        m = tree["mu"][node]
        a, b = d <= m, d > m - tree["radius"]
        point, node = np.concatenate([point[a], point[b]]), np.concatenate([tree["near"][node[a]], tree["far"][node[b]]])
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable along the edges (a, b) from each of n points."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while True:
            jumped = root[root]
            if (jumped == root).all():
                break
            root = jumped
        if (before == root).all():
            break
    return root


def spanning_links(f: np.ndarray, distance: int = DISTANCE, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of indices that connect what links of distinct fingerprints connect."""
    n, ends_a, ends_b = len(f), [], []
    for i in range(0, n - 1, block):
        rows, cols = f[i:i + block], f[i:]
        hit = np.bitwise_count(rows[:, None] ^ cols[None, :]) <= distance
        hit[np.arange(len(rows)), np.arange(len(rows))] = False
        total = int(hit.sum())
        if not total:
            continue
        if total <= 8 * n:
            r, c = np.nonzero(hit)
        else:  # dense: what meets in a column is one piece, so a spanning set is enough
            label = np.arange(len(rows))
            while True:
                col = np.where(hit, label[:, None], len(rows)).min(axis=0)
                new = np.minimum(label, np.where(hit, col[None, :], len(rows)).min(axis=1))
                if (new == label).all():
                    break
                label = new
            used = np.flatnonzero(col < len(rows))
            joined = np.flatnonzero(label != np.arange(len(rows)))
            r, c = np.concatenate([col[used], label[joined]]), np.concatenate([used, joined])
        ends_a.append(r + i)
        ends_b.append(c + i)
    if not ends_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    root = _roots(n, np.concatenate(ends_a), np.concatenate(ends_b))
    moved = np.flatnonzero(root != np.arange(n))
    return root[moved], moved


def bounded_sample(classes: DataFrame, fp: str, n: int, size: int = SAMPLE) -> np.ndarray:
    """About ``size`` of ``n`` distinct fingerprints (all, if no more): those whose
    hash lies below a threshold, so no task and not the driver sees others."""
    grain = 1 << 40
    below = grain if n <= size else int(grain * (size / n))
    kept = classes.where(F.pmod(F.xxhash64(fp), F.lit(grain)) < below)
    return np.sort(kept.toPandas()[fp].to_numpy(np.int64).view(np.uint64))


def linked_fingerprints(classes: DataFrame, fp: str = "fp", distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b: links that connect the distinct fingerprints of ``classes``."""
    spark = classes.sparkSession
    n = classes.count()
    sample = bounded_sample(classes.select(fp), fp, n)
    trees = [build_tree(sample, mask, distance // PARTS) for mask in part_masks()]
    scale = n / max(1, len(sample))
    groups = [np.maximum(1, np.ceil(t["count"] * scale / LEAF_ROWS)).astype(np.int64) for t in trees]
    shared = spark.sparkContext.broadcast((trees, groups))  # bounded by the sample

    def routed(batches):
        trees, groups = shared.value
        for batch in batches:
            f = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, tree in enumerate(trees):
                point, leaf = route(tree, f)
                g = groups[k][leaf]
                mine = (f[point] % np.maximum(1, g).astype(np.uint64)).astype(np.int64)
                copies = np.repeat(np.arange(len(point)), g)
                other = np.arange(len(copies)) - np.repeat(np.cumsum(g) - g, g)
                low, high = np.minimum(mine[copies], other), np.maximum(mine[copies], other)
                place = ((np.int64(k) << 56) | (leaf[copies] << 32) | (low << 16) | high)
                for i in range(0, len(place), 1 << 18):
                    yield pa.RecordBatch.from_arrays([pa.array(place[i:i + (1 << 18)]), pa.array(f[point[copies[i:i + (1 << 18)]]].view(np.int64))],
                                                     names=["leaf", "fp"])

    def compared(batches):
        """Whole leaves from rows sorted by leaf; the last one waits for the next batch."""
        leaf, f = np.empty(0, np.int64), np.empty(0, np.uint64)

        def links(leaf, f):
            cuts = np.flatnonzero(np.diff(leaf)) + 1
            found = [(p[a], p[b]) for p in np.split(f, cuts) if len(p) > 1 for a, b in [spanning_links(p, distance)] if len(a)]
            if found:
                a, b = (np.concatenate([x[k] for x in found]).view(np.int64) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            leaf = np.concatenate([leaf, batch.column(0).to_numpy(zero_copy_only=False)])
            f = np.concatenate([f, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(leaf) and leaf[0] != leaf[-1]:
                last = int(np.searchsorted(leaf, leaf[-1]))
                yield from links(leaf[:last], f[:last])
                leaf, f = leaf[last:], f[last:]
        if len(leaf):
            yield from links(leaf, f)

    return (classes.select(fp).mapInArrow(routed, "leaf long, fp long")
            .repartition("leaf").sortWithinPartitions("leaf")
            .mapInArrow(compared, "a long, b long").distinct())


def component_roots(links: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``links`` (a, b): rounds of contraction.

    In a round every vertex moves to its smallest neighbour and edges are
    redrawn between the places moved to, until none is left; the moves of
    all rounds are then followed.  Each round is written to the shared folder.
    """
    edges, moves = materialise(links, "links-0"), []
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = materialise(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m"))
                         .select("v", F.least("v", "m").alias("p")), f"moves-{len(moves)}")
        moves.append(to)
        left, right = to.toDF("va", "pa"), to.toDF("vb", "pb")
        edges = materialise(edges.join(left, F.col("a") == F.col("va")).join(right, F.col("b") == F.col("vb"))
                            .where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
                            .distinct(), f"links-{len(moves)}")
        if edges.isEmpty():
            break
    out = moves[0].toDF("v", "root")
    for move in moves[1:]:
        out = (out.join(move.toDF("at", "to"), F.col("root") == F.col("at"), "left")
               .select("v", F.coalesce("to", "root").alias("root")))
    return out


def components(marked: DataFrame, least: Column, fp: str = "fp") -> DataFrame:
    """(fp, component): for each distinct fingerprint the smallest ``least``
    among all rows that its links reach."""
    classes = materialise(marked.groupBy(fp).agg(F.min(least).alias("first")).select(F.col(fp).alias("fp"), "first"), "simhash-classes")
    roots = component_roots(linked_fingerprints(classes))
    grouped = materialise(classes.join(roots, F.col("fp") == F.col("v")).select("fp", "first", "root"), "simhash-linked")
    merged = grouped.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("merged"))
    linked = grouped.join(merged, F.col("root") == F.col("r")).select(F.col("fp").alias("lfp"), "merged")
    return (classes.join(linked, F.col("fp") == F.col("lfp"), "left")
            .select("fp", F.when(F.col("lfp").isNull(), F.col("first")).otherwise(F.col("merged")).alias("component")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component): one row per row of ``docs``."""
    marked = materialise(add_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))), "simhash-marked")
    found = components(marked, F.col("doc_id")).toDF("cfp", "component")
    return marked.join(found, F.col("fp") == F.col("cfp"), "left").select("doc_id", "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (null ids
    last; of rows that repeat an id the one with the smallest hash)."""
    own, kept_id, kept_hash = fresh(docs, "row_hash", "kept_id", "kept_hash")
    hashed = docs.withColumn(own, F.xxhash64(*docs.columns))
    marked = materialise(add_fingerprint(hashed.select(F.col(id_col).alias("id"), F.col(own).alias("h"), F.col(text).alias("text"))),
                         "simhash-rows")
    least = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("id"), F.col("h").alias("h"))
    kept = components(marked, least).select(F.col("component.id").alias(kept_id), F.col("component.h").alias(kept_hash)).distinct()
    return (hashed.join(kept, F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.col(own) == F.col(kept_hash)), "left_semi")
            .dropDuplicates([id_col, own]).select(*docs.columns))


def simhash_query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                        F.col("component").alias("component_id"))
