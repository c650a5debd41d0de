"""Query catalogue: the operators applied to the driver's test tables.

Mapping of the original record fields onto ``events``: user -> ``user_id``,
url / event kind -> ``event_type``, timestamp -> ``ts_ms`` (epoch ms).
Events arrive every few minutes, so the original second-scale durations are
scaled up with their ratios kept (5 s -> 1 h, 10 s/2 s -> 5 h/1 h,
10 s/5 s -> 2 h/1 h, 10 s -> 2 h).  Every query reads whole tables; the two
inputs of a join are made from ``events`` by event type, and the payments of
``reconcile_payments`` from the first line item of each order.

Each entry of ``QUERIES`` is ``(spark, sf_dir) -> DataFrame``; ``ORACLES``
holds the equivalent DuckDB SQL over the same parquet tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import duration_ms
from eventide.operators import cep, joins, partitioning, relational, rolling, stateful, sinks, topn, usercode, windows
from eventide.session import shared_path
from eventide.sources.tables import events, read_table, with_millis

H = duration_ms("1 hour")
DAY = duration_ms("1 day")

# Parameters of the queries (scaled durations, see module docstring).
TUMBLE_USER_MS = 1 * H          # 5 s tumbling count per user
TUMBLE_UV_MS = 1 * H            # 5 s distinct visitors
TUMBLE_URL_PV_MS = 2 * H        # 10 s hand-made tumbling window
PV_UV_SIZE_MS, PV_UV_SLIDE_MS = 5 * H, 1 * H        # 10 s / 2 s
URL_SIZE_MS, URL_SLIDE_MS = 2 * H, 1 * H            # 10 s / 5 s
TOP_N = 2
WINDOW_JOIN_MS = 5 * H          # 5 s window join
INTERVAL_LOWER_MS, INTERVAL_UPPER_MS = -6 * H, 12 * H   # -5 min .. +10 min
RECONCILE_WAIT_MS = 365 * DAY
ITEM_WAIT_MS = 45 * DAY         # several line items of one order
TIMER_DELAY_MS = 1000
PERIOD_MS = 10 * H              # 10 s periodic pv
COUNT_WINDOW = 5
NTH_EVENT = 6
BUFFER_THRESHOLD = 10
CEP_WITHIN_MS = 24 * H
SESSION_GAP_MS = 6 * H
ANSWER_WAIT_MS = 48 * H

ORDER = ["ts_ms", "event_id"]   # total order of events within a user

EV = "SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ts_ms FROM events"
CENTS_SQL = "CAST(round(value * 100) AS BIGINT)"
RUN = "PARTITION BY user_id ORDER BY ts_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _ev(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf)


EVENT_FIELDS = ["user_id", "event_type", "ts_ms"]


def _event_text(df: DataFrame) -> DataFrame:
    return relational.record_text(df, "Event", EVENT_FIELDS)


EVENT_TEXT_SQL = "'Event(' || user_id || ',' || event_type || ',' || (epoch_us(ts) // 1000) || ')'"

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, oracle: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


# --- sources, projection, filters --------------------------------------------

@query("source_events", "SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ts_ms FROM events")
def source_events(spark, sf):
    return _ev(spark, sf)


@query("project_field", "SELECT event_type FROM events")
def project_field(spark, sf):
    return relational.project(_ev(spark, sf), "event_type")


@query("filter_contains", f"SELECT event_id, user_id, event_type, ts_ms FROM ({EV}) WHERE contains(event_type, 'i')")
def filter_contains(spark, sf):
    return relational.filter_contains(_ev(spark, sf), "event_type", "i") \
        .select("event_id", "user_id", "event_type", "ts_ms")


@query("filter_equals", f"SELECT event_id, user_id, event_type, ts_ms FROM ({EV}) WHERE event_type = 'view'")
def filter_equals(spark, sf):
    return relational.filter_equals(_ev(spark, sf), "event_type", "view") \
        .select("event_id", "user_id", "event_type", "ts_ms")


@query("flatmap_repeat", """
SELECT e.event_id, e.user_id, e.event_type, CAST(c.copy AS INTEGER) AS copy
FROM events e JOIN (VALUES ('view', 1), ('click', 1), ('click', 2)) c(t, copy) ON e.event_type = c.t
""")
def flatmap_repeat(spark, sf):
    return relational.flat_repeat(_ev(spark, sf), "event_type", {"view": 1, "click": 2},
                                  ["event_id", "user_id", "event_type"])


@query("rich_map_timestamp", "SELECT event_id, epoch_us(ts) // 1000 AS ts_ms FROM events")
def rich_map_timestamp(spark, sf):
    def opened(partition_id):
        return {"task": partition_id, "rows": 0}

    def body(pdf, ctx):
        ctx["rows"] += len(pdf)
        return pdf[["event_id", "ts_ms"]]

    def closed(ctx):
        ctx.clear()

    return relational.map_with_lifecycle(_ev(spark, sf).select("event_id", "ts_ms"), body,
                                         "event_id bigint, ts_ms bigint", opened, closed)


@query("sql_projection", "SELECT event_type, user_id FROM events")
def sql_projection(spark, sf):
    return relational.sql_over(_ev(spark, sf), "clicks", "SELECT event_type, user_id FROM {clicks}")


# --- partitioning --------------------------------------------------------------

@query("partition_custom", """
SELECT CAST(event_id % 2 AS INTEGER) AS part, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS sum_value
FROM events GROUP BY 1
""")
def partition_custom(spark, sf):
    ev = _ev(spark, sf).select("event_id")
    return partitioning.partition_summary(ev, 2, F.pmod(F.col("event_id"), F.lit(2)), "event_id")


@query("replicate_rows", "SELECT e.event_id, CAST(r.i AS INTEGER) AS replica FROM events e, range(4) r(i)")
def replicate_rows(spark, sf):
    return partitioning.replicate(_ev(spark, sf).select("event_id"), 4)


# --- rolling aggregates --------------------------------------------------------

def _rolling_sql(agg: str, out: str) -> str:
    return (f"SELECT event_id, user_id, ts_ms, CAST({agg} OVER ({RUN}) AS BIGINT) AS {out} "
            f"FROM (SELECT *, {CENTS_SQL} AS cents FROM ({EV}))")


def _cents(spark, sf):
    return _ev(spark, sf).select("event_id", "user_id", "ts_ms", F.round(F.col("value") * 100).cast("bigint").alias("cents"))


@query("rolling_sum", _rolling_sql("sum(cents)", "running_sum"))
def rolling_sum(spark, sf):
    return rolling.rolling(_cents(spark, sf), "user_id", ORDER, "cents", "sum", "running_sum").drop("cents")


@query("rolling_max", _rolling_sql("max(cents)", "running_max"))
def rolling_max(spark, sf):
    return rolling.rolling(_cents(spark, sf), "user_id", ORDER, "cents", "max", "running_max").drop("cents")


@query("rolling_min", _rolling_sql("min(cents)", "running_min"))
def rolling_min(spark, sf):
    return rolling.rolling(_cents(spark, sf), "user_id", ORDER, "cents", "min", "running_min").drop("cents")


@query("rolling_count", _rolling_sql("count(*)", "running_count"))
def rolling_count(spark, sf):
    return rolling.rolling(_cents(spark, sf), "user_id", ORDER, None, "count", "running_count").drop("cents")


def _extreme_by_sql(fn: str, sign: str) -> str:
    key = f"struct_pack(c := cents, t := {sign}ts_ms, i := {sign}event_id)"
    return f"""
SELECT event_id, user_id, ts_ms, cents,
       {fn}(event_id, {key}) OVER ({RUN}) AS best_event_id,
       {fn}(cents, {key}) OVER ({RUN}) AS best_cents
FROM (SELECT *, {CENTS_SQL} AS cents FROM ({EV}))"""


@query("rolling_max_by", _extreme_by_sql("arg_max", "-"))
def rolling_max_by(spark, sf):
    df = _cents(spark, sf)
    return rolling.rolling_extreme_by(df, "user_id", ORDER, "cents", ["event_id", "cents"], "max")


@query("rolling_min_by", _extreme_by_sql("arg_min", ""))
def rolling_min_by(spark, sf):
    df = _cents(spark, sf)
    return rolling.rolling_extreme_by(df, "user_id", ORDER, "cents", ["event_id", "cents"], "min")


@query("most_active_user", f"""
WITH c AS (SELECT event_id, user_id, ts_ms, count(*) OVER ({RUN}) AS user_count FROM ({EV}))
SELECT event_id, user_id, ts_ms, user_count,
       arg_max(user_id, struct_pack(c := user_count, t := ts_ms, i := event_id))
         OVER (ORDER BY ts_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS top_user,
       max(user_count) OVER (ORDER BY ts_ms, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS top_count
FROM c""")
def most_active_user(spark, sf):
    df = _ev(spark, sf).select("event_id", "user_id", "ts_ms")
    return rolling.most_active_so_far(df, "user_id", ORDER)


# --- windows and top-N ---------------------------------------------------------

def _tumble_sql(size: int) -> str:
    return f"(ts_ms // {size}) * {size}"


@query("tumbling_count", f"""
SELECT {_tumble_sql(TUMBLE_USER_MS)} AS window_start, {_tumble_sql(TUMBLE_USER_MS)} + {TUMBLE_USER_MS} AS window_end,
       user_id, count(*) AS cnt
FROM ({EV}) GROUP BY 1, 2, 3""")
def tumbling_count(spark, sf):
    return windows.count_per_window(_ev(spark, sf), "ts_ms", TUMBLE_USER_MS, keys=["user_id"])


@query("tumbling_uv", f"""
SELECT {_tumble_sql(TUMBLE_UV_MS)} AS window_start, {_tumble_sql(TUMBLE_UV_MS)} + {TUMBLE_UV_MS} AS window_end,
       count(DISTINCT user_id) AS uv
FROM ({EV}) GROUP BY 1, 2""")
def tumbling_uv(spark, sf):
    return windows.distinct_per_window(_ev(spark, sf), "ts_ms", TUMBLE_UV_MS, "user_id")


@query("tumbling_url_pv", f"""
SELECT {_tumble_sql(TUMBLE_URL_PV_MS)} AS window_start, {_tumble_sql(TUMBLE_URL_PV_MS)} + {TUMBLE_URL_PV_MS} AS window_end,
       event_type, count(*) AS pv
FROM ({EV}) GROUP BY 1, 2, 3""")
def tumbling_url_pv(spark, sf):
    return windows.count_per_window(_ev(spark, sf), "ts_ms", TUMBLE_URL_PV_MS, keys=["event_type"], out="pv")


def _sliding_sql(size: int, slide: int) -> str:
    """Rows of ``ev`` exploded to every sliding window holding them."""
    return (f"SELECT e.*, (e.ts_ms // {slide} - r.i) * {slide} AS window_start, "
            f"(e.ts_ms // {slide} - r.i) * {slide} + {size} AS window_end "
            f"FROM ({EV}) e, range({size // slide}) r(i)")


@query("sliding_pv_per_uv", f"""
SELECT window_start, window_end, count(*) AS pv, count(DISTINCT user_id) AS uv,
       CAST(count(*) AS DOUBLE) / count(DISTINCT user_id) AS pv_per_uv
FROM ({_sliding_sql(PV_UV_SIZE_MS, PV_UV_SLIDE_MS)}) GROUP BY 1, 2""")
def sliding_pv_per_uv(spark, sf):
    return windows.pv_per_uv(_ev(spark, sf), "ts_ms", PV_UV_SIZE_MS, PV_UV_SLIDE_MS, "user_id")


@query("sliding_url_count", f"""
SELECT window_start, window_end, event_type, count(*) AS cnt
FROM ({_sliding_sql(URL_SIZE_MS, URL_SLIDE_MS)}) GROUP BY 1, 2, 3""")
def sliding_url_count(spark, sf):
    return windows.count_per_window(_ev(spark, sf), "ts_ms", URL_SIZE_MS, URL_SLIDE_MS, ["event_type"])


@query("window_average", f"""
SELECT window_start, window_end, event_type, CAST(sum(cents) AS DOUBLE) / count(cents) AS avg_cents, max(cents) - min(cents) AS spread
FROM (SELECT *, {CENTS_SQL} AS cents FROM ({_sliding_sql(PV_UV_SIZE_MS, PV_UV_SLIDE_MS)})) GROUP BY 1, 2, 3""")
def window_average(spark, sf):
    cents = F.round(F.col("value") * 100).cast("bigint")
    return windows.accumulate(
        _ev(spark, sf), "ts_ms", PV_UV_SIZE_MS, PV_UV_SLIDE_MS, ["event_type"],
        {"total": ("sum", cents), "n": ("count", cents), "low": ("min", cents), "high": ("max", cents)},
        {"avg_cents": F.col("total").cast("double") / F.col("n"), "spread": F.col("high") - F.col("low")})


TOP_N_SQL = f"""
SELECT * FROM (
  SELECT window_start, window_end, event_type, cnt,
         CAST(row_number() OVER (PARTITION BY window_start, window_end ORDER BY cnt DESC, event_type) AS INTEGER) AS rank
  FROM (SELECT window_start, window_end, event_type, count(*) AS cnt
        FROM ({_sliding_sql(URL_SIZE_MS, URL_SLIDE_MS)}) GROUP BY 1, 2, 3))
WHERE rank <= {TOP_N}"""


@query("top_n_per_window", TOP_N_SQL)
def top_n_per_window(spark, sf):
    return topn.top_n_per_window(_ev(spark, sf), "ts_ms", "event_type", URL_SIZE_MS, URL_SLIDE_MS, TOP_N)


@query("top_n_window_all", TOP_N_SQL)
def top_n_window_all(spark, sf):
    return topn.top_n_all_items(_ev(spark, sf), "ts_ms", "event_type", URL_SIZE_MS, URL_SLIDE_MS, TOP_N)


# --- joins -----------------------------------------------------------------------

def _typed(spark, sf, kind: str, prefix: str) -> DataFrame:
    df = _ev(spark, sf).where(F.col("event_type") == kind).select("user_id", "event_id", "ts_ms")
    return joins.prefixed(df, prefix + "_", keep=["user_id"])


@query("window_join", f"""
WITH p AS (SELECT user_id, event_id, ts_ms FROM ({EV}) WHERE event_type = 'purchase'),
     v AS (SELECT user_id, event_id, ts_ms FROM ({EV}) WHERE event_type = 'view')
SELECT p.user_id, {_tumble_sql(WINDOW_JOIN_MS).replace('ts_ms', 'p.ts_ms')} AS window_start,
       {_tumble_sql(WINDOW_JOIN_MS).replace('ts_ms', 'p.ts_ms')} + {WINDOW_JOIN_MS} AS window_end,
       p.event_id AS purchase_event_id, p.ts_ms AS purchase_ts_ms,
       v.event_id AS view_event_id, v.ts_ms AS view_ts_ms
FROM p JOIN v ON p.user_id = v.user_id AND p.ts_ms // {WINDOW_JOIN_MS} = v.ts_ms // {WINDOW_JOIN_MS}""")
def window_join(spark, sf):
    p, v = _typed(spark, sf, "purchase", "purchase"), _typed(spark, sf, "view", "view")
    return joins.window_join(p, v, "user_id", "purchase_ts_ms", "view_ts_ms", WINDOW_JOIN_MS)


@query("interval_join", f"""
WITH p AS (SELECT user_id, event_id, ts_ms FROM ({EV}) WHERE event_type = 'purchase'),
     v AS (SELECT user_id, event_id, ts_ms FROM ({EV}) WHERE event_type = 'view')
SELECT p.user_id, p.event_id AS purchase_event_id, p.ts_ms AS purchase_ts_ms,
       v.event_id AS view_event_id, v.ts_ms AS view_ts_ms
FROM p JOIN v ON p.user_id = v.user_id
 AND v.ts_ms BETWEEN p.ts_ms + ({INTERVAL_LOWER_MS}) AND p.ts_ms + {INTERVAL_UPPER_MS}""")
def interval_join(spark, sf):
    p, v = _typed(spark, sf, "purchase", "purchase"), _typed(spark, sf, "view", "view")
    return joins.interval_join(p, v, "user_id", "purchase_ts_ms", "view_ts_ms",
                               INTERVAL_LOWER_MS, INTERVAL_UPPER_MS)


@query("full_history_join", f"""
WITH p AS (SELECT user_id, event_id, ts_ms FROM ({EV}) WHERE event_type = 'purchase'),
     s AS (SELECT user_id, event_id, ts_ms FROM ({EV}) WHERE event_type = 'signup')
SELECT p.user_id, p.event_id AS purchase_event_id, p.ts_ms AS purchase_ts_ms,
       s.event_id AS signup_event_id, s.ts_ms AS signup_ts_ms
FROM p JOIN s ON p.user_id = s.user_id""")
def full_history_join(spark, sf):
    p, s = _typed(spark, sf, "purchase", "purchase"), _typed(spark, sf, "signup", "signup")
    return joins.full_history_join(p, s, "user_id")


@query("reconcile_payments", f"""
WITH a AS (SELECT o_orderkey AS id, epoch_us(o_orderdate) // 1000 AS t FROM orders),
     b AS (SELECT l_orderkey AS id, min(epoch_us(l_shipdate) // 1000) AS t FROM lineitem GROUP BY 1)
SELECT coalesce(a.id, b.id) AS pay_id, a.t AS app_ts, b.t AS third_ts,
       CASE WHEN a.id IS NOT NULL AND b.id IS NOT NULL THEN 'ok'
            WHEN a.id IS NOT NULL THEN 'missing_third_party' ELSE 'missing_app' END AS status
FROM a FULL OUTER JOIN b ON a.id = b.id AND abs(a.t - b.t) <= {RECONCILE_WAIT_MS}""")
def reconcile_payments(spark, sf):
    app = with_millis(read_table(spark, sf, "orders"), "o_orderdate", "t") \
        .select(F.col("o_orderkey").alias("id"), "t")
    third = (with_millis(read_table(spark, sf, "lineitem"), "l_shipdate", "t")
             .groupBy(F.col("l_orderkey").alias("id")).agg(F.min("t").alias("t")))
    return joins.reconcile(app, third, "id", "t", "t", RECONCILE_WAIT_MS)


@query("reconcile_line_items", f"""
WITH RECURSIVE e AS (
  SELECT id, t, side, row_number() OVER (PARTITION BY id ORDER BY t, side) AS n FROM (
    SELECT o_orderkey AS id, epoch_us(o_orderdate) // 1000 AS t, 0 AS side FROM orders
    UNION ALL SELECT l_orderkey, epoch_us(l_shipdate) // 1000, 1 FROM lineitem)),
s(id, n, app, third, timers, out_app, out_third, out_status, late_app, late_third) AS (
  SELECT DISTINCT id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST([] AS BIGINT[]),
         CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM e
  UNION ALL
  SELECT id, n,
         CASE WHEN side = 0 AND c IS NULL THEN t WHEN side = 1 THEN NULL ELSE NULL END,
         CASE WHEN side = 1 AND a IS NULL THEN t ELSE NULL END,
         CASE WHEN (side = 0 AND c IS NOT NULL) OR (side = 1 AND a IS NOT NULL) THEN live ELSE list_append(live, t + {ITEM_WAIT_MS}) END,
         CASE WHEN side = 0 AND c IS NOT NULL THEN t WHEN side = 1 AND a IS NOT NULL THEN a END,
         CASE WHEN side = 0 AND c IS NOT NULL THEN c WHEN side = 1 AND a IS NOT NULL THEN t END,
         CASE WHEN (side = 0 AND c IS NOT NULL) OR (side = 1 AND a IS NOT NULL) THEN 'ok' END,
         CASE WHEN due THEN app END, CASE WHEN due THEN third END
  FROM (
    SELECT e.id, e.n, e.t, e.side, s.app, s.third, due, live, CASE WHEN due THEN NULL ELSE s.app END AS a, CASE WHEN due THEN NULL ELSE s.third END AS c
    FROM (SELECT s0.*, e0.t AS t0, len(list_filter(s0.timers, lambda x: x < e0.t)) > 0 AS due, list_filter(s0.timers, lambda x: x >= e0.t) AS live
          FROM s s0 JOIN e e0 ON e0.id = s0.id AND e0.n = s0.n + 1) s
    JOIN e ON e.id = s.id AND e.n = s.n + 1))
SELECT id AS pay_id, out_app AS app_ts, out_third AS third_ts, out_status AS status FROM s WHERE out_status IS NOT NULL
UNION ALL SELECT id, late_app, NULL, 'missing_third_party' FROM s WHERE late_app IS NOT NULL
UNION ALL SELECT id, NULL, late_third, 'missing_app' FROM s WHERE late_third IS NOT NULL
UNION ALL SELECT s.id, s.app, s.third, CASE WHEN s.app IS NULL THEN 'missing_app' ELSE 'missing_third_party' END
FROM s JOIN (SELECT id, max(n) AS n FROM s GROUP BY id) m ON s.id = m.id AND s.n = m.n
WHERE s.app IS NOT NULL OR s.third IS NOT NULL""")
def reconcile_line_items(spark, sf):
    app = with_millis(read_table(spark, sf, "orders"), "o_orderdate", "t") \
        .select(F.col("o_orderkey").alias("id"), "t")
    third = with_millis(read_table(spark, sf, "lineitem"), "l_shipdate", "t") \
        .select(F.col("l_orderkey").alias("id"), "t")
    return joins.reconcile(app, third, "id", "t", "t", ITEM_WAIT_MS)


# --- timers and keyed state -------------------------------------------------------

@query("arrival_and_timer", f"""
SELECT 'arrival' AS kind, event_id, ts_ms AS at_ms FROM ({EV})
UNION ALL
SELECT DISTINCT 'timer' AS kind, CAST(NULL AS BIGINT) AS event_id, ts_ms + {TIMER_DELAY_MS} AS at_ms FROM ({EV})""")
def arrival_and_timer(spark, sf):
    return stateful.arrival_and_timer(_ev(spark, sf), None, "ts_ms", "event_id", TIMER_DELAY_MS)


@query("periodic_pv", f"""
WITH RECURSIVE ev AS (SELECT user_id, epoch_us(ts) // 1000 AS t FROM events),
chain(user_id, anchor) AS (
  SELECT user_id, min(t) FROM ev GROUP BY user_id
  UNION ALL
  SELECT c.user_id, (SELECT min(e.t) FROM ev e WHERE e.user_id = c.user_id AND e.t > c.anchor + {PERIOD_MS})
  FROM chain c WHERE c.anchor IS NOT NULL
)
SELECT c.user_id, c.anchor + {PERIOD_MS} AS fire_ts,
       (SELECT count(*) FROM ev e WHERE e.user_id = c.user_id AND e.t <= c.anchor + {PERIOD_MS}) AS pv
FROM chain c WHERE c.anchor IS NOT NULL""")
def periodic_pv(spark, sf):
    return stateful.periodic_counts(_ev(spark, sf), "user_id", "ts_ms", PERIOD_MS)


@query("count_window_avg", f"""
WITH s AS (SELECT user_id, ts_ms, row_number() OVER ({RUN}) AS rn FROM ({EV}))
SELECT user_id, (rn - 1) // {COUNT_WINDOW} AS window_no, CAST(sum(ts_ms) // {COUNT_WINDOW} AS BIGINT) AS avg_ts
FROM s GROUP BY 1, 2 HAVING count(*) = {COUNT_WINDOW}""")
def count_window_avg(spark, sf):
    return stateful.count_window_avg(_ev(spark, sf), "user_id", ORDER, "ts_ms", COUNT_WINDOW)


@query("nth_event_avg", f"""
WITH s AS (SELECT user_id, ts_ms, row_number() OVER ({RUN}) AS rn FROM ({EV}))
SELECT user_id, CAST(sum(ts_ms) // {NTH_EVENT} AS BIGINT) AS avg_ts
FROM s WHERE rn <= {NTH_EVENT} GROUP BY 1 HAVING count(*) = {NTH_EVENT}""")
def nth_event_avg(spark, sf):
    return stateful.nth_event_avg(_ev(spark, sf), "user_id", ORDER, "ts_ms", NTH_EVENT)


@query("buffered_batches", f"""
WITH s AS (SELECT event_id, user_id, event_type, ts_ms,
                  row_number() OVER (ORDER BY ts_ms, event_id) AS rn FROM ({EV})),
     b AS (SELECT *, (rn - 1) // {BUFFER_THRESHOLD} AS batch_no,
                  CAST((rn - 1) % {BUFFER_THRESHOLD} + 1 AS BIGINT) AS pos FROM s)
SELECT event_id, user_id, event_type, ts_ms, batch_no, pos FROM b
WHERE batch_no < (SELECT count(*) // {BUFFER_THRESHOLD} FROM s)""")
def buffered_batches(spark, sf):
    df = _ev(spark, sf).select("event_id", "user_id", "event_type", "ts_ms")
    return stateful.buffered_batches(df, ORDER, BUFFER_THRESHOLD)


# --- own code ------------------------------------------------------------------------

class Sessions(usercode.KeyedProcess):
    """A user's activity, closed by a timer that each event moves."""

    output = "user_id bigint, first_ts bigint, last_ts bigint, n bigint, errors bigint"

    def __init__(self, gap_ms: int):
        self.gap = gap_ms

    def on_event(self, ctx, row):
        first, last, n, errors = ctx.state or (row["ts_ms"], None, 0, 0)
        if last is not None:
            ctx.delete_timer(last + self.gap)
        ctx.state = (first, row["ts_ms"], n + 1, errors + (row["event_type"] == "error"))
        ctx.set_timer(row["ts_ms"] + self.gap)

    def on_timer(self, ctx, at):
        ctx.emit(*ctx.key, *ctx.state)
        ctx.state = None


@query("keyed_process_sessions", f"""
WITH s AS (SELECT user_id, event_type, ts_ms, event_id,
                  coalesce(ts_ms - lag(ts_ms) OVER (PARTITION BY user_id ORDER BY ts_ms, event_id) > {SESSION_GAP_MS}, true) AS opens FROM ({EV})),
     n AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER ({RUN}) AS nth FROM s)
SELECT user_id, min(ts_ms) AS first_ts, max(ts_ms) AS last_ts, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors
FROM n GROUP BY user_id, nth""")
def keyed_process_sessions(spark, sf):
    df = _ev(spark, sf).select("user_id", "event_type", "ts_ms", "event_id")
    return usercode.keyed_process(df, ["user_id"], ORDER, Sessions(SESSION_GAP_MS))


class SignupAnswer(usercode.KeyedProcess):
    """Two inputs: the purchases of a user that follow the latest signup within a time."""

    output = "user_id bigint, signup_ts bigint, purchases bigint"

    def __init__(self, wait_ms: int):
        self.wait = wait_ms

    def on_event(self, ctx, row):
        if row["side"] == 0:
            if ctx.state:
                ctx.delete_timer(ctx.state[0] + self.wait)
                ctx.emit(*ctx.key, *ctx.state)
            ctx.state = (row["ts_ms"], 0)
            ctx.set_timer(row["ts_ms"] + self.wait)
        elif ctx.state:
            ctx.state = (ctx.state[0], ctx.state[1] + 1)

    def on_timer(self, ctx, at):
        ctx.emit(*ctx.key, *ctx.state)
        ctx.state = None


@query("connected_process", f"""
WITH e AS (SELECT user_id, event_id, ts_ms, event_type = 'signup' AS s FROM ({EV}) WHERE event_type IN ('signup', 'purchase')),
     g AS (SELECT *, sum(CAST(s AS INTEGER)) OVER ({RUN}) AS nth FROM e),
     f AS (SELECT *, min(ts_ms) FILTER (s) OVER (PARTITION BY user_id, nth) AS signup_ts FROM g WHERE nth > 0)
SELECT user_id, signup_ts, count(*) FILTER (NOT s AND ts_ms <= signup_ts + {ANSWER_WAIT_MS}) AS purchases
FROM f GROUP BY user_id, nth, signup_ts""")
def connected_process(spark, sf):
    side = lambda kind: _ev(spark, sf).where(F.col("event_type") == kind).select("user_id", "ts_ms", "event_id")
    both = usercode.connect(side("signup"), side("purchase"))
    return usercode.keyed_process(both, ["user_id"], ORDER, SignupAnswer(ANSWER_WAIT_MS))


class Visitors(usercode.UserAggregate):
    """Page views per visitor from a set of visitors and a count."""

    output = "pv bigint, uv bigint, pv_per_uv double"

    def create(self):
        return set(), 0

    def add(self, acc, row):
        acc[0].add(row["user_id"])
        return acc[0], acc[1] + 1

    def merge(self, a, b):
        return a[0] | b[0], a[1] + b[1]

    def result(self, acc):
        return acc[1], len(acc[0]), acc[1] / len(acc[0])


@query("user_aggregate_visitors", f"""
SELECT w AS window_start, w + {PV_UV_SIZE_MS} AS window_end, event_type, count(*) AS pv, count(DISTINCT user_id) AS uv,
       CAST(count(*) AS DOUBLE) / count(DISTINCT user_id) AS pv_per_uv
FROM (SELECT event_type, user_id, unnest(generate_series(ts_ms - ts_ms % {PV_UV_SLIDE_MS} - {PV_UV_SIZE_MS - PV_UV_SLIDE_MS},
                                                         ts_ms - ts_ms % {PV_UV_SLIDE_MS}, {PV_UV_SLIDE_MS})) AS w FROM ({EV}))
GROUP BY w, event_type""")
def user_aggregate_visitors(spark, sf):
    df = _ev(spark, sf).select("event_type", "user_id", "ts_ms")
    return usercode.window_aggregate(df, "ts_ms", PV_UV_SIZE_MS, PV_UV_SLIDE_MS, ["event_type"], Visitors())


def _largest_and_times(a: tuple, b: tuple) -> tuple:
    """The larger value and how often it has come."""
    return a if a[0] > b[0] else b if b[0] > a[0] else (a[0], a[1] + b[1])


@query("running_reduce_largest", f"""
WITH m AS (SELECT *, max(value) OVER ({RUN}) AS largest FROM ({EV}))
SELECT event_id, user_id, ts_ms, largest,
       count(*) FILTER (value = largest) OVER (PARTITION BY user_id, largest ORDER BY ts_ms, event_id) AS times
FROM m""")
def running_reduce_largest(spark, sf):
    df = _ev(spark, sf).select("event_id", "user_id", "ts_ms", "value", F.lit(1).cast("bigint").alias("one"))
    return usercode.running_reduce(df, ["user_id"], ORDER, ["value", "one"], _largest_and_times, ["largest", "times"]) \
        .select("event_id", "user_id", "ts_ms", "largest", "times")


# --- event patterns -----------------------------------------------------------------

def _err():
    return F.col("event_type") == "error"

STRICT_SQL = f"""
WITH s AS (
  SELECT user_id, event_id, event_type, ts_ms,
         lead(event_type, 1) OVER w AS t1, lead(event_type, 2) OVER w AS t2,
         lead(ts_ms, 1) OVER w AS s1, lead(ts_ms, 2) OVER w AS s2,
         lead(event_id, 1) OVER w AS i1, lead(event_id, 2) OVER w AS i2
  FROM ({EV}) WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, event_id))
SELECT * FROM s WHERE event_type = 'error' AND t1 = 'error' AND t2 = 'error'"""


@query("cep_strict_sequence", f"SELECT user_id, ts_ms AS first_ts, s1 AS second_ts, s2 AS third_ts FROM ({STRICT_SQL})")
def cep_strict_sequence(spark, sf):
    return cep.strict_sequence(_ev(spark, sf), "user_id", ORDER, [_err()] * 3, "ts_ms",
                               ["first_ts", "second_ts", "third_ts"])


@query("cep_times_consecutive", f"SELECT user_id, ts_ms AS first_ts, s2 AS last_ts FROM ({STRICT_SQL})")
def cep_times_consecutive(spark, sf):
    return cep.times_consecutive(_ev(spark, sf), "user_id", ORDER, _err(), 3, "ts_ms")


@query("cep_flat_select", f"""
WITH m AS ({STRICT_SQL})
SELECT user_id, ts_ms AS match_ts, 0 AS step, ts_ms, event_id FROM m
UNION ALL SELECT user_id, ts_ms, 1, s1, i1 FROM m
UNION ALL SELECT user_id, ts_ms, 2, s2, i2 FROM m""")
def cep_flat_select(spark, sf):
    return cep.flat_select(_ev(spark, sf), "user_id", ORDER, [_err()] * 3,
                           ["ts_ms", "event_id"], "ts_ms")


FOLLOWED_SQL = f"""
WITH n AS (
  SELECT user_id, event_id, event_type, ts_ms,
         min(CASE WHEN event_type = 'purchase' THEN struct_pack(t := ts_ms, i := event_id) END)
           OVER (PARTITION BY user_id ORDER BY ts_ms, event_id
                 ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
  FROM ({EV})),
b AS (SELECT *, nxt.t IS NOT NULL AND nxt.t - ts_ms < {CEP_WITHIN_MS} AS ok FROM n WHERE event_type = 'signup')
SELECT user_id, ts_ms AS begin_ts, event_id AS begin_event_id,
       CASE WHEN ok THEN nxt.t END AS end_ts, CASE WHEN ok THEN nxt.i END AS end_event_id,
       CASE WHEN ok THEN 'matched' ELSE 'timeout' END AS status,
       CASE WHEN ok THEN NULL ELSE ts_ms + {CEP_WITHIN_MS} END AS timeout_ts
FROM b"""


def _followed(spark, sf):
    return cep.followed_by_within(_ev(spark, sf), "user_id", "ts_ms", "event_id",
                                  F.col("event_type") == "signup", F.col("event_type") == "purchase",
                                  CEP_WITHIN_MS, ["event_id"], ["event_id"])


@query("cep_followed_by", f"SELECT user_id, begin_ts, begin_event_id, end_ts, end_event_id FROM ({FOLLOWED_SQL}) WHERE status = 'matched'")
def cep_followed_by(spark, sf):
    return _followed(spark, sf).where(F.col("status") == cep.STATUS_MATCHED) \
        .select("user_id", "begin_ts", "begin_event_id", "end_ts", "end_event_id")


@query("cep_timeout", FOLLOWED_SQL)
def cep_timeout(spark, sf):
    return _followed(spark, sf)


# --- sinks ----------------------------------------------------------------------------

@query("sink_text_roundtrip", f"SELECT {EVENT_TEXT_SQL} AS value FROM events")
def sink_text_roundtrip(spark, sf):
    path = shared_path(spark, "text-sink")
    sinks.write_text(_event_text(_ev(spark, sf)), path)
    return spark.read.text(path)


@query("sink_kafka_payload", f"SELECT 'clinks' AS topic, CAST(user_id AS VARCHAR) AS key, {EVENT_TEXT_SQL} AS value FROM events")
def sink_kafka_payload(spark, sf):
    ev = _ev(spark, sf).withColumn("value", relational.record_text_col("Event", EVENT_FIELDS))
    return sinks.kafka_payload(ev, "value", "clinks", key="user_id")


@query("sink_hash_upsert", """SELECT user_id, arg_max(event_type, struct_pack(t := ts, i := event_id)) AS event_type
FROM events GROUP BY user_id""")
def sink_hash_upsert(spark, sf):
    path = shared_path(spark, "hash-sink")
    writer = sinks.upsert_writer(sinks.parquet_store(path), "user_id", ["event_type"], ORDER)
    writer(_ev(spark, sf), 0)
    return sinks.latest(spark, path, "user_id", ["event_type"], ORDER).select("user_id", "event_type")


@query("sink_document_payload", """SELECT '{"' || user_id || '":"' || event_type || '"}' AS doc FROM events""")
def sink_document_payload(spark, sf):
    return sinks.document_payload(_ev(spark, sf), "user_id", "event_type")
