"""Approximate nearest neighbours by a hash-prefix forest.

Each tree turns a vector into a long hash string: symbol j names the axis
(and its sign) that lies nearest to the vector under the tree's j-th random
rotation, so near vectors share long prefixes.  A tree is a set of sorted
arrays of these strings, one per first symbol.  A query descends each tree
along its ``p`` most likely symbols at every level, to ``p ** level`` prefixes
of ``level`` symbols.  If the entries with those prefixes are fewer than
``wanted``, it ascends all trees at once, one symbol at a time; the entries of
the level where it stops are scored with the exact cosine in double precision.
If one symbol is still too few, the query is held against all rows, in blocks.
An entry that several trees find counts about once.

How deep a descent starts, and how wide, is measured on the table: ``SAMPLE``
of the queries are held against all entries.  For each level the smallest
``p`` is taken that reaches ``RECALL`` of their true neighbours, and of these
rungs the one with the least work: entries scored, prefixes looked up, and
rows moved (a query's copies and their results), each of which costs about
``MOVED`` times as much.  The same rule holds at every size; the more rows a
table has, the deeper the cheapest rung lies and the smaller the share of the
rows that a query meets.

Equal vectors are searched once: a class of them is one entry that knows its
smallest ids, so a vector that a third of all rows share costs one entry.
Sorted arrays above ``BLOCK_ROWS`` entries are cut into blocks from counted
sizes.  Only these (``trees * 2 * dims`` numbers) and the sample with its
neighbours (``SAMPLE * (k + 1)`` vectors) are collected.

Defined results: vectors that are null, empty, zero, of another length than
the most common one, or hold null or non-finite components take no part, neither as query nor as
candidate; rows that repeat an id with an equal vector count once; ties go to
the smaller id; fewer candidates than ``k`` give fewer rows; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.llm.common import materialise

TREES = 12
SYMBOLS = 5            # of a hash string; 7 bits each at 64 axes
AXES = 64              # of a rotation, at most
BLOCK_ROWS = 65_536    # entries of one sorted array, at most
BLOCK_QUERIES = 16_384
ROOT_BLOCKS = 8        # blocks of all rows, at least
PAIRS = 1_000_000      # (query, prefix) or (query, entry) pairs at once in a task, about
SMALL = 256            # pairs of a prefix below which it is not worth a product of its own
MOVED = 100            # scored entries that take as long as one row through a shuffle (6 us to 0.05 us, measured)
SAMPLE = 256           # queries whose true neighbours are sought, at most
RECALL = 0.97          # of the sample's true neighbours that a descent must reach
SEED = 20_011


def wanted(k: int) -> int:
    """Entries a query of ``k`` neighbours gathers before it stops ascending."""
    return 10 * k


def _rotations(dim: int, trees: int) -> np.ndarray:
    """(trees, symbols, dim, axes) orthonormal columns, the same everywhere."""
    rng = np.random.default_rng(SEED)
    axes = min(AXES, dim)
    return np.stack([[np.linalg.qr(rng.standard_normal((dim, dim)))[0][:, :axes] for _ in range(SYMBOLS)]
                     for _ in range(trees)]).astype(np.float32)


def _symbols(v: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    p = v @ rotation
    a = np.abs(p).argmax(1)
    return 2 * a + (p[np.arange(len(v)), a] > 0)


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _likely(u: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """All symbols for each vector, the most likely first."""
    p = u @ rotation
    both = np.stack([-p, p], axis=2).reshape(len(u), -1)  # at 2 * axis + sign
    return np.argsort(-both, axis=1, kind="stable")


def _unit(v: np.ndarray) -> np.ndarray:
    return (v / np.sqrt((v * v).sum(1))[:, None]).astype(np.float32)


def _hashed(dim: int, trees: int):
    """Entries (class_id, v) to rows (class_id, v, tree, symbol, hash)."""
    def run(batches):
        rot = _rotations(dim, trees)
        for batch in batches:
            if not batch.num_rows:
                continue
            u = _unit(_matrix(batch.column("v"), dim))
            for t in range(trees):
                first, rest = _symbols(u, rot[t, 0]).astype(np.int64), np.zeros(len(u), np.int64)
                for s in range(1, SYMBOLS):
                    rest = rest * 128 + _symbols(u, rot[t, s])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("class_id"), batch.column("v"), pa.array(np.full(len(u), t, np.int32)),
                     pa.array(first.astype(np.int32)), pa.array(first * 128 ** (SYMBOLS - 1) + rest)],
                    names=["class_id", "v", "tree", "symbol", "hash"])
    return run


def _descents(dim: int, trees: int, depth: int, width: int):
    """Queries (class_id, v) to rows (class_id, v, tree, symbol, likely), one
    for each of ``width`` first symbols; ``likely`` holds the ``width`` symbols
    of each later level, a byte each."""
    def run(batches):
        rot = _rotations(dim, trees)
        for batch in batches:
            if not batch.num_rows:
                continue
            u = _unit(_matrix(batch.column("v"), dim))
            for t in range(trees):
                firsts = _likely(u, rot[t, 0])[:, :width]
                later = [_likely(u, rot[t, s])[:, :width].astype(np.uint8) for s in range(1, depth)]
                rows = np.concatenate(later, axis=1) if later else np.empty((len(u), 0), np.uint8)
                likely = pa.array([r.tobytes() for r in rows], pa.binary())
                for k in range(firsts.shape[1]):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("class_id"), batch.column("v"), pa.array(np.full(len(u), t, np.int32)),
                         pa.array(firsts[:, k].astype(np.int32)), likely],
                        names=["class_id", "v", "tree", "symbol", "likely"])
    return run


def _prefixes(queries: pa.Table, rows: np.ndarray, level: int, width: int) -> np.ndarray:
    """(rows, width ** (level - 1)) prefixes of ``level`` symbols."""
    out = queries.column("symbol").to_numpy()[rows].astype(np.int64)[:, None]
    if level > 1:
        raw = b"".join(queries.column("likely").take(pa.array(rows)).to_pylist())
        later = np.frombuffer(raw, np.uint8).reshape(len(rows), -1, width).astype(np.int64)
        for j in range(level - 1):
            out = (out[:, :, None] * 128 + later[:, j, None, :]).reshape(len(rows), -1)
    return out


def _stretches(queries: pa.Table, rows: np.ndarray, h: np.ndarray, level: int, width: int):
    """Bounds in the sorted array ``h`` of each row's prefixes, some rows at a time."""
    step = max(1, PAIRS // width ** max(0, level - 1))
    for i in range(0, len(rows), step):
        part = rows[i:i + step]
        if level == 0:
            yield part, np.zeros((len(part), 1), np.int64), np.full((len(part), 1), len(h))
        else:
            low, span = _prefixes(queries, part, level, width), 128 ** (SYMBOLS - level)
            yield part, np.searchsorted(h, low * span), np.searchsorted(h, (low + 1) * span)


def _levels(depth: int, width: int):
    """Of one sorted array: entries in each query's prefixes of 1, 2, ... symbols."""
    def run(queries: pa.Table, members: pa.Table) -> pa.Table:
        h, rows = np.sort(members.column("hash").to_numpy()), np.arange(queries.num_rows)
        found = [(part, level, (hi - lo).sum(1)) for level in range(1, depth + 1)
                 for part, lo, hi in _stretches(queries, rows, h, level, width)]
        at = np.concatenate([x[0] for x in found]) if found else rows
        return pa.table({"query_class": queries.column("class_id").to_numpy()[at],
                         "tree": queries.column("tree").to_numpy()[at],
                         "level": np.concatenate([np.full(len(x[0]), x[1], np.int32) for x in found]) if found else at.astype(np.int32),
                         "n": np.concatenate([x[2] for x in found]).astype(np.int64) if found else at.astype(np.int64)})
    return run


def _best(dim: int, k: int, width: int = 1):
    """The k nearest entries of one sorted array for each of its queries."""
    def run(queries: pa.Table, members: pa.Table) -> pa.Table:
        h, ids = members.column("hash").to_numpy(), members.column("class_id").to_numpy()
        names, levels = queries.column("class_id").to_numpy(), queries.column("level").to_numpy()
        kept: list[tuple] = []
        if queries.num_rows and members.num_rows:
            order = np.lexsort((ids, h))
            h, ids = h[order], ids[order]
            m, q = _matrix(members.column("v"), dim)[order], _matrix(queries.column("v"), dim)
            mn, qn = np.sqrt((m * m).sum(1)), np.sqrt((q * q).sum(1))
            mu, qu = m / mn[:, None], q / qn[:, None]

            def top(found):
                """The k best of some (query, entry) pairs for each query, scored on the original vectors."""
                r, c = (np.concatenate([x[i] for x in found]) for i in (0, 1))
                exact = np.concatenate([np.einsum("ij,ij->i", q[r[i:i + PAIRS]], m[c[i:i + PAIRS]]) for i in range(0, len(r), PAIRS)])
                exact = exact / (qn[r] * mn[c])
                first = np.lexsort((ids[c], -exact, r))
                r, c, exact = r[first], c[first], exact[first]
                keep = np.arange(len(r)) - np.searchsorted(r, r) < k
                return r[keep], c[keep], exact[keep]

            for level in np.unique(levels):
                for part, lo, hi in _stretches(queries, np.flatnonzero(levels == level), h, int(level), width):
                    at, one = np.nonzero(hi > lo)
                    if not len(at):
                        continue
                    row, lo, hi = part[at], lo[at, one], hi[at, one]
                    by = np.argsort(lo, kind="stable")
                    row, lo, hi = row[by], lo[by], hi[by]
                    cuts = np.concatenate(([0], np.flatnonzero(np.diff(lo)) + 1, [len(lo)]))
                    work = np.diff(cuts) * (hi - lo)[cuts[:-1]]
                    found = []
                    # queries that share a stretch of the array are scored as one product
                    for g in np.flatnonzero(work > SMALL):
                        a, b, mine = lo[cuts[g]], hi[cuts[g]], row[cuts[g]:cuts[g + 1]]
                        step = max(1, 2 * PAIRS // (b - a))
                        for i in range(0, len(mine), step):
                            rows = mine[i:i + step]
                            s = qu[rows] @ mu[a:b].T
                            floor = np.partition(s, -k, axis=1)[:, -k] if b - a > k else np.full(len(rows), -2.0)
                            r, c = np.nonzero(s >= floor[:, None] - 1e-9)
                            found.append((rows[r], a + c))
                            if sum(len(x[0]) for x in found) > PAIRS:
                                found = [top(found)[:2]]
                    small = np.repeat(work <= SMALL, np.diff(cuts))
                    row, lo, n = row[small], lo[small], (hi - lo)[small]
                    ends = np.cumsum(n)
                    i = 0
                    while i < len(row):  # the others pair by pair
                        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS, "right")))
                        c = np.arange(n[i:j].sum()) - np.repeat(np.cumsum(n[i:j]) - n[i:j], n[i:j]) + np.repeat(lo[i:j], n[i:j])
                        found = [top([*found, (np.repeat(row[i:j], n[i:j]), c)])[:2]]
                        i = j
                    kept.append(top(found))
        col = lambda i, t: np.concatenate([x[i] for x in kept]) if kept else np.empty(0, t)
        return pa.table({"query_class": names[col(0, np.int64)].astype(np.int64), "class_id": ids[col(1, np.int64)].astype(np.int64),
                         "score": col(2, np.float64).astype(np.float64)})
    return run


def _true_neighbours(ids: np.ndarray, q: np.ndarray, k: int):
    """The k nearest entries of a task's rows for each vector of the sample."""
    def run(batches):
        qn = q / np.sqrt((q * q).sum(1))[:, None]
        names, score, vecs = np.empty((len(q), 0), np.int64), np.empty((len(q), 0)), np.empty((len(q), 0, q.shape[1]))
        kind = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.schema.field("v").type
            m, own = _matrix(batch.column("v"), q.shape[1]), batch.column("class_id").to_numpy()
            s = qn @ (m / np.sqrt((m * m).sum(1))[:, None]).T
            s[ids[:, None] == own[None, :]] = -np.inf
            top = np.argpartition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k]
            names = np.concatenate([names, own[top]], 1)
            score = np.concatenate([score, np.take_along_axis(s, top, 1)], 1)
            vecs = np.concatenate([vecs, m[top]], 1)
            top = np.argpartition(-score, min(k, score.shape[1]) - 1, axis=1)[:, :k]
            names, score = np.take_along_axis(names, top, 1), np.take_along_axis(score, top, 1)
            vecs = np.take_along_axis(vecs, top[:, :, None], 1)
        real = score > -np.inf
        if real.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, score.shape[1])[real.ravel()]), pa.array(names[real]),
                 pa.array(list(vecs[real]), pa.list_(kind.value_type)), pa.array(score[real])],
                names=["query_class", "class_id", "v", "score"])
    return run


def _ranks_needed(q: np.ndarray, m: np.ndarray, trees: int) -> np.ndarray:
    """(pairs, symbols): how many likely symbols at each level a descent of
    ``q[i]`` must follow to find ``m[i]`` by 1, 2, ... symbols in some tree."""
    rot = _rotations(q.shape[1], trees)
    q, m = _unit(q), _unit(m)
    need = np.full((len(q), SYMBOLS), 1 << 30)
    for t in range(trees):
        deep = np.zeros(len(q), np.int64)
        for s in range(SYMBOLS):
            rank = (_likely(q, rot[t, s]) == _symbols(m, rot[t, s])[:, None]).argmax(1) + 1
            deep = np.maximum(deep, rank)
            need[:, s] = np.minimum(need[:, s], deep)
    return need


def cheapest_rung(need: np.ndarray, n: int, trees: int, symbols: int, k: int) -> tuple[int, int]:
    """(level, p) with the least work of the rungs that reach ``RECALL``."""
    rungs = []
    for level in range(1, SYMBOLS + 1):
        p = int(np.sort(need[:, level - 1])[max(0, math.ceil(RECALL * len(need)) - 1)])
        share = 1 - (1 - (p / symbols) ** level) ** trees
        rungs.append((n * share + trees * float(p) ** level + MOVED * trees * p * (k + 2), level, p))
    return min(rungs)[1:]


def fitted_rung(entries: DataFrame, searched: DataFrame, n: int, dim: int, k: int, trees: int) -> tuple[int, int]:
    """The rung at which this table's descents start, from a sample of its queries."""
    sample = searched.orderBy(F.xxhash64("class_id"), "class_id").limit(SAMPLE).collect()
    if not sample:
        return 0, 1
    ids, q = np.array([r["class_id"] for r in sample]), np.array([r["v"] for r in sample], np.float64)
    near = Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id")
    element = entries.schema["v"].dataType.simpleString()
    true = (entries.mapInArrow(_true_neighbours(ids, q, k), f"query_class long, class_id long, v {element}, score double")
            .withColumn("r", F.row_number().over(near)).where(F.col("r") <= k).select("query_class", "v").collect())
    if not true:
        return 0, 1
    at = {c: i for i, c in enumerate(ids.tolist())}
    mine = np.array([at[r["query_class"]] for r in true])
    need = _ranks_needed(q[mine], np.array([r["v"] for r in true], np.float64), trees)
    return cheapest_rung(need, n, trees, 2 * min(AXES, dim), k)


def _dealt(df: DataFrame, own: dict, other: dict, salt: Column, mine: str, theirs: str) -> DataFrame:
    """Rows with a block number of their own and one copy per block opposite.

    ``own`` and ``other`` map ``tree * 2 * AXES + symbol`` to block counts above 1.
    """
    def blocks(counts):
        if not counts:
            return F.lit(1)
        m = F.create_map(*[F.lit(x) for kv in counts.items() for x in kv])
        return F.coalesce(F.element_at(m, F.col("tree") * (2 * AXES) + F.col("symbol")), F.lit(1))
    return (df.withColumn(mine, F.pmod(salt, blocks(own)).cast("int"))
            .withColumn(theirs, F.explode(F.sequence(F.lit(0), blocks(other).cast("int") - 1))))


def _block_counts(df: DataFrame, size: int) -> dict:
    """Block counts of the sorted arrays that need more than one."""
    rows = (df.groupBy((F.col("tree") * (2 * AXES) + F.col("symbol")).alias("k")).count()
            .where(F.col("count") > size).collect())  # at most trees * 2 * AXES rows
    return {r["k"]: -(-r["count"] // size) for r in rows}


def vector_classes(vectors: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """Distinct usable vectors: (class_id, v, ids), ids the k + 1 smallest."""
    v = F.col(vec_col)
    usable = (v.isNotNull() & F.col(id_col).isNotNull() & (F.size(v) > 0)
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
              & F.exists(v, lambda x: x != 0))
    rows = vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), v.alias("v")).distinct()
    first = Window.partitionBy("v").orderBy("id")  # planned as a limit before the exchange
    return (rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
            .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
            .select(F.element_at("ids", 1).alias("class_id"), "v", "ids"))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            trees: int = TREES) -> DataFrame:
    """Each query's ``k`` nearest other rows: (query_id, rank, vec_id, score)."""
    spark = vectors.sparkSession
    schema_out = "query_id long, rank int, vec_id long, score double"
    classes = materialise(vector_classes(vectors, id_col, vec_col, k), "ann-classes")
    dims = (classes.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first())
    if dims is None:
        return spark.createDataFrame([], schema_out)
    dim, n = dims["d"], dims["count"]
    classes = classes.where(F.size("v") == dim)
    asked = (vectors.where(is_query & F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
             .select(F.col(id_col).cast("long").alias("query_id"), F.col(vec_col).alias("v")).distinct()
             .join(classes.select("class_id", "v"), "v").select("query_id", "class_id"))
    asked = materialise(asked, "ann-asked")
    entries = classes.select("class_id", "v")
    searched = entries.join(asked.select("class_id").distinct(), "class_id", "left_semi").toDF("class_id", "v")

    element = classes.schema["v"].dataType.simpleString()
    depth, width = fitted_rung(entries, searched, n, dim, k, trees)
    members = entries.mapInArrow(_hashed(dim, trees), f"class_id long, v {element}, tree int, symbol int, hash long")
    queries = searched.mapInArrow(_descents(dim, trees, depth, width),
                                  f"class_id long, v {element}, tree int, symbol int, likely binary")
    salt = F.xxhash64("class_id")
    level = searched.select("class_id", F.lit(0).alias("level"))
    found = spark.createDataFrame([], "query_class long, class_id long, score double")
    if depth:
        large, many = _block_counts(members, BLOCK_ROWS), _block_counts(queries, BLOCK_QUERIES)
        keys = ["tree", "symbol", "member_block", "query_block"]
        m = lambda df: _dealt(df, large, many, salt, "member_block", "query_block")
        q = lambda df: _dealt(df, many, large, salt, "query_block", "member_block")
        counted = (q(queries.drop("v")).groupBy(*keys).cogroup(m(members.drop("v")).groupBy(*keys))
                   .applyInArrow(_levels(depth, width), "query_class long, tree int, level int, n long"))
        enough = wanted(k)
        # different entries, as if each tree chose by itself: n (1 - product of (1 - share of the tree))
        missed = F.exp(F.sum(F.log1p(-F.least(F.col("n") / n, F.lit(1 - 1e-12)))))
        level = (counted.groupBy("query_class", "level", "tree").agg(F.sum("n").alias("n"))
                 .groupBy("query_class", "level").agg((n * (1 - missed)).alias("n"))
                 .groupBy("query_class").agg(F.coalesce(F.max(F.when(F.col("n") >= enough, F.col("level"))), F.lit(0)).alias("level")))
        level = materialise(level.withColumnRenamed("query_class", "class_id"), "ann-levels")
        stopped = q(queries).join(level.where("level > 0"), "class_id")
        found = (stopped.groupBy(*keys).cogroup(m(members).groupBy(*keys))
                 .applyInArrow(_best(dim, k + 1, width), "query_class long, class_id long, score double"))
    # the top of the climb: the remaining queries against all entries, in blocks
    blocks, query_blocks = max(ROOT_BLOCKS, -(-n // BLOCK_ROWS)), max(1, n // (50 * BLOCK_QUERIES))
    rest = (searched.join(level.where("level = 0"), "class_id").withColumn("hash", F.lit(0).cast("long"))
            .withColumn("query_block", F.pmod(salt, F.lit(query_blocks)).cast("int"))
            .withColumn("member_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    if level.where("level = 0").limit(1).count():
        every = (entries.withColumn("hash", F.lit(0).cast("long")).withColumn("member_block", F.pmod(salt, F.lit(blocks)).cast("int"))
                 .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
        both = ["member_block", "query_block"]
        found = found.unionByName(rest.groupBy(*both).cogroup(every.groupBy(*both))
                                  .applyInArrow(_best(dim, k + 1), "query_class long, class_id long, score double"))

    near = Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id")
    top = (found.groupBy("query_class", "class_id").agg(F.max("score").alias("score"))
           .withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1).drop("r"))
    listed = (top.join(classes.select("class_id", "ids"), "class_id")
              .select("query_class", "score", F.explode("ids").alias("vec_id")))
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.join(listed, asked["class_id"] == listed["query_class"]).where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
