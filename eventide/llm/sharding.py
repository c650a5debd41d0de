"""Sharding by balanced label propagation.

Documents of equal texts are linked.  Every document starts in a shard by its
hash; then, round by round, the documents of a group move to that of the
group's shards which holds most of its bytes, as far as the target's quota
reaches: its room and what leaves it in the same round.  Equal shares are
decided by a hash, so no shard is preferred.  A group that quotas keep apart
moves whole to any shard with room, every other round; a group that needs m
shards spreads over its m largest.  Group sums are the messages: a group of
any size is at most ``shards * SPLIT`` rows in a round, never pairs.

Documents without links cost no edge wherever they are, so they fill what is
left: the few that are large by themselves one by one, the rest by running
sums, which makes the sizes nearly equal (law ``bytes``).  What overfills a
shard goes into the same pool by whole groups, and so do groups still apart;
copies lie side by side there, so that only those at a shard's ends are cut.
A group larger than a shard is split.

Only DataFrame functions and joins.  To the driver come a shard's load
(``shards`` numbers), the movers' sums by target, bucket and source
(``shards * QUOTA_BUCKETS`` rows of ``shards`` numbers) and the large single documents (at most
``shards * LARGE``, since each holds 1 / ``LARGE`` of a shard or more).

Defined results: a null text has size 8 and is equal to an empty one; null ids
are placed like others; repeated rows are separate documents of one group; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventide.llm.common import materialise, ranked

SHARDS = 24
ROUNDS = 4
OVERHEAD = 8           # bytes a document has besides its text
QUOTA_BUCKETS = 256
SPLIT = 16             # parts of a group that start in one shard and move by themselves
LARGE = 64             # a document of more than 1 / LARGE of a shard is placed by itself
BUCKET_ROWS = 50_000
SLACK = 0.05           # of a shard that the rounds may overfill; the pool levels it


def nodes(docs: DataFrame, shards: int, id_col: str, text: str) -> DataFrame:
    """(row, doc_id, size, text_crc32, g1, g2, home); g1, g2 name the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        (F.octet_length(t) + OVERHEAD).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"),
        F.xxhash64(t).alias("g1"), F.xxhash64(F.lit(1), t, F.octet_length(t)).alias("g2"))
    return rows.withColumn("home", F.pmod(F.xxhash64("row", "doc_id"), F.lit(shards * SPLIT)).cast("int"))


def _loads(parts: DataFrame, shards: int) -> list[int]:
    got = {r["at"]: r["b"] for r in parts.groupBy("at").agg(F.sum("bytes").alias("b")).collect()}
    return [int(got.get(s) or 0) for s in range(shards)]


def _accepted(asked: list, loads: list[int], limit: float) -> list[set[int]]:
    """The buckets of movers that each shard takes.

    ``asked`` has rows (aim, bucket, bytes from shard 0, 1, ...).  All moves
    are made at first, so what leaves a shard is room in it; then shards above
    the limit give buckets back until none is above or has any left.
    """
    shards, now = range(len(loads)), [float(b) for b in loads]
    cells: list[dict[int, list[int]]] = [{} for _ in shards]
    for aim, bucket, *sent in asked:
        cells[aim][bucket] = [b or 0 for b in sent]
        for s in shards:
            now[s] -= cells[aim][bucket][s]
        now[aim] += sum(cells[aim][bucket])
    while over := [s for s in shards if now[s] > limit and cells[s]]:
        t = max(over, key=lambda s: now[s])
        size = {b: sum(sent) for b, sent in cells[t].items()}
        enough = [b for b in size if size[b] >= now[t] - limit]
        b = min(enough, key=lambda b: (size[b], b)) if enough else max(size, key=lambda b: (size[b], -b))
        for s, back in zip(shards, cells[t].pop(b)):
            now[s] += back
        now[t] -= size[b]
    return [set(c) for c in cells]


def propagate(parts: DataFrame, shards: int, capacity: float, rounds: int = ROUNDS) -> DataFrame:
    """Move parts (g1, g2, home, bytes, at) towards their groups' shards."""
    group, place = Window.partitionBy("g1", "g2"), Window.partitionBy("g1", "g2", "at")
    limit = capacity * (1 + SLACK)
    for k in range(rounds):
        loads = _loads(parts, shards)
        # equal masses go to each shard alike, by a hash
        held = (parts.withColumn("mass", F.sum("bytes").over(place)).withColumn("need", _need(group, capacity))
                .withColumn("own", F.struct("mass", F.xxhash64("g1", "g2", "at").alias("tie"), "at")))
        best = F.slice(F.sort_array(F.collect_set("own").over(group), asc=False), F.lit(1), F.col("need"))
        pick = F.element_at("best", F.pmod(F.xxhash64("g1", "home"), F.size("best")).cast("int") + 1)
        wish = held.withColumn("best", best).withColumn("aim", F.when(F.array_contains("best", F.col("own")), F.col("at")).otherwise(pick["at"]))
        if k % 2:  # groups that quotas kept apart go whole to any shard with room
            free = [max(0.0, limit - b) for b in loads]
            u = F.pmod(F.xxhash64("g1", "g2", F.lit(k)), F.lit(1 << 20)) * (sum(free) / (1 << 20))
            other = F.lit(max(range(shards), key=lambda s: free[s]))
            for s in reversed(range(shards)):
                other = F.when((u < sum(free[:s + 1])) & F.lit(free[s] > 0), F.lit(s)).otherwise(other)
            apart = (F.col("need") == 1) & (F.size(F.collect_set("at").over(group)) > 1)
            wish = wish.withColumn("aim", F.when(apart & F.lit(sum(free) > 0), other).otherwise(F.col("aim")))
        # a group that fits a shard is in one bucket, so all of it moves or none
        bucket = F.pmod(F.xxhash64("g1", "g2", F.when(F.col("need") > 1, F.col("home")), F.lit(k)), F.lit(QUOTA_BUCKETS)).cast("int")
        wish = wish.withColumn("bucket", bucket)
        asked = (wish.where("aim <> at").groupBy("aim", "bucket")
                 .agg(*[F.sum(F.when(F.col("at") == s, F.col("bytes"))).alias(f"b{s}") for s in range(shards)]).collect())
        if not asked:
            break
        taken = _accepted(asked, loads, limit)
        marks = F.array(*[F.lit("".join("01"[b in t] for b in range(QUOTA_BUCKETS))) for t in taken])
        moves = F.substr(F.element_at(marks, F.col("aim") + 1), F.col("bucket") + 1, F.lit(1)) == "1"
        moved = wish.withColumn("at", F.when(moves, F.col("aim")).otherwise(F.col("at")))
        parts = materialise(moved.select("g1", "g2", "home", "bytes", "at"), f"shard-parts-{k}")
    return parts


def _need(group, capacity: float) -> Column:
    """Shards that a group fills."""
    return F.greatest(F.ceil(F.sum("bytes").over(group) / F.lit(max(capacity, 1.0))).cast("int"), F.lit(1))


def settled(parts: DataFrame, capacity: float, buckets: int) -> DataFrame:
    """``parts`` with ``stays``: whether the shard holds the part for good.

    A group that fits a shard stays whole or goes whole; one that is still
    apart goes.  A larger group stays by its parts.
    """
    group = Window.partitionBy("g1", "g2")
    held = (parts.withColumn("need", _need(group, capacity))
            .withColumn("apart", (F.col("need") == 1) & (F.size(F.collect_set("at").over(group)) > 1))
            .withColumn("unit", F.when(F.col("need") > 1, F.col("home")).otherwise(F.lit(-1))))
    units = held.where(~F.col("apart")).groupBy("g1", "g2", "unit", "at").agg(F.sum("bytes").alias("unit_bytes"))
    # the few large ones first, since they are the hardest to place
    bucket = F.when(F.col("unit_bytes") > capacity / LARGE, F.lit(0)) \
        .otherwise(F.pmod(F.xxhash64("g1", "g2", "unit"), F.lit(buckets)) + 1)
    kept = (ranked(units, ["at"], [F.col("g1"), F.col("g2"), F.col("unit")], bucket, "nth", "unit_bytes", "before")
            .where(F.col("before") + F.col("unit_bytes") <= capacity)
            .select(F.col("g1").alias("u1"), F.col("g2").alias("u2"), F.col("unit").alias("u3")))
    same = (F.col("g1") == F.col("u1")) & (F.col("g2") == F.col("u2")) & (F.col("unit") == F.col("u3"))
    return held.join(kept, same & ~F.col("apart"), "left") \
        .select("g1", "g2", "home", "at", F.col("u1").isNotNull().alias("stays"))


def _nearest_room(loads: list[float], sizes: list[tuple], capacity: float) -> dict[int, int]:
    """Large documents (row, size, group), largest first, each to the emptiest
    shard; the copies of one text to one shard if it can hold them."""
    out, groups = {}, {}
    for row, size, group in sorted(sizes, key=lambda x: (-x[1], x[0])):
        groups.setdefault(group, []).append((row, size))
    for rows in groups.values():
        s = min(range(len(loads)), key=lambda i: (loads[i], i))
        whole = loads[s] + sum(size for _, size in rows) <= capacity
        for row, size in rows:
            if not whole:
                s = min(range(len(loads)), key=lambda i: (loads[i], i))
            out[row] = s
            loads[s] += size
    return out


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text: str = "text",
           rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs``."""
    spark = docs.sparkSession
    node = materialise(nodes(docs, shards, id_col, text), "shard-nodes")
    all_rows = node.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("b")).first()
    capacity, buckets = all_rows["b"] / shards, max(512, all_rows["n"] // BUCKET_ROWS)
    group = Window.partitionBy("k1", "k2")
    parts = (node.groupBy(F.col("g1").alias("k1"), F.col("g2").alias("k2"), F.col("home").alias("k3"))
             .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
             .withColumn("all", F.sum("n").over(group)).where(F.col("all") > 1)
             .select(F.col("k1").alias("g1"), F.col("k2").alias("g2"), F.col("k3").alias("home"), "bytes", "all",
                     (F.col("k3") % shards).alias("at")))
    parts = materialise(parts, "shard-parts")
    rows_of = parts.groupBy("g1", "g2").agg(F.max("all").alias("all")).toDF("r1", "r2", "all")
    placed = settled(propagate(parts.drop("all"), shards, capacity, rounds), capacity, buckets) \
        .join(rows_of, (F.col("g1") == F.col("r1")) & (F.col("g2") == F.col("r2"))) \
        .select(F.col("g1").alias("k1"), F.col("g2").alias("k2"), F.col("home").alias("k3"), "at", "stays", "all")
    same = (F.col("g1") == F.col("k1")) & (F.col("g2") == F.col("k2")) & (F.col("home") == F.col("k3"))
    labelled = materialise(node.join(placed, same, "left").select("row", "doc_id", "size", "text_crc32", "g1", "g2", "at", "stays", "all"),
                           "shard-linked")

    # what a shard cannot hold, what is still apart and all without links go into the pool
    spread = F.pmod(F.xxhash64("row"), F.lit(buckets))
    held = labelled.where("stays")
    pool = labelled.where(~F.coalesce(F.col("stays"), F.lit(False)))
    loads = [float(b) for b in _loads(held.select("at", F.col("size").alias("bytes")), shards)]
    large = pool.where(F.col("size") > capacity / LARGE).select("row", "size", F.struct("g1", "g2").alias("g")).collect()  # at most shards * LARGE rows
    alone = _nearest_room(loads, [(r["row"], r["size"], tuple(r["g"])) for r in large], capacity)
    small = pool.where(F.col("size") <= capacity / LARGE)
    amount = float(small.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b")).first()["b"])
    free = _levels(loads, amount)
    # copies side by side, so that they share a shard but for those at its two ends;
    # a group of many rows takes as many buckets next to each other
    width = F.greatest(F.floor(F.col("all") * buckets / all_rows["n"]), F.lit(1)) if all_rows["n"] else F.lit(1)
    near = F.pmod(F.xxhash64("g1", "g2"), F.lit(buckets)) + F.pmod(F.xxhash64("row"), F.coalesce(width, F.lit(1)))
    filled = ranked(small, [], [F.col("g1"), F.col("g2"), F.col("row")], near, "nth", "size", "before")
    middle, shard, ceiling = F.col("before") + F.col("size") / 2, F.lit(shards - 1), sum(free)
    for s in reversed(range(shards - 1)):
        ceiling -= free[s + 1]
        shard = F.when(middle < ceiling, F.lit(s)).otherwise(shard)
    columns = ["row", "doc_id", "size", "text_crc32", "shard"]
    out = held.withColumnRenamed("at", "shard").select(*columns) \
        .unionByName(filled.withColumn("shard", shard).select(*columns))
    if alone:
        values = ", ".join(f"({row}L, {s})" for row, s in alone.items())
        own = spark.sql(f"SELECT * FROM VALUES {values} AS t(large_row, shard)")
        out = out.unionByName(pool.join(own, F.col("row") == F.col("large_row")).select(*columns))
    out = materialise(out.withColumn("shard", F.col("shard").cast("int")), "shard-assigned")
    return ranked(out, ["shard"], [F.col("doc_id"), F.col("row")], spread, "slot").drop("row")


def _levels(loads: list[float], amount: float) -> list[float]:
    """What each shard gets of ``amount`` so that all are as level as can be."""
    order, n = sorted(loads), len(loads)
    level, total = 0.0, 0.0
    for k in range(1, n + 1):
        total += order[k - 1]
        level = (amount + total) / k
        if k == n or level <= order[k]:
            break
    return [max(0.0, level - b) for b in loads]


def sharding_query(docs: DataFrame) -> DataFrame:
    return assign(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                               F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
