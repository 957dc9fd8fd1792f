"""Bindings from the driver tables to the engine's two long tables.

* ``metric_points``: one row per (ip_port, server_name, ts bucket) with
  ``connection_count``, ``qps``, ``response_time``, ``eps``.
* ``edge_points``: one row per observed call (ts, src, dst, rt, error).
* counters (``requests_total``, ``duration_bucket``, ``duration_sum``):
  cumulative samples on an hourly scrape grid, derived from ``edge_points``.

Everything is a lazy DataFrame over ``spark.read.parquet``; column pruning and
filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewise.functions.columns import epoch_seconds
from tracewise.operators.series import previous_row

# Fixed values of the bindings.
N_SERVER_NAMES = 5                   # ServerName = 'svc_' + user_id % 5
N_IP_PORTS = 2                       # IP_port = '10.0.0.' + user_id % 2 + ':8080'
METRIC_BUCKET = "6 hours"            # service metric grain
PHASE_SPLIT = "2024-01-22 00:00:00"  # baseline before, problem from here on
N_SERVERS = 20                       # server_id = user_id % 20
SERVER_TYPES = ["DB", "Web", "App"]  # type = SERVER_TYPES[server_id % 3]
ERROR_K = 90                         # props.k >= 90 marks a 5xx call
PLANTED = [("view", "click"), ("click", "purchase")]   # edges of the planted fault
FAULT_STEPS = 20                     # scored steps of the planted service fault
TRADE_SIGMA = 1.0                    # how far above the average pair a trade edge lies
PLANT_HOURS = 30                     # its length, up to the newest event
PLANT_K = 98                         # failing calls beside it
LE_BOUNDS = [10.0, 25.0, 50.0, 100.0, 250.0, float("inf")]  # latency buckets
SCRAPE_STEP = "1 hour"               # counter sample grid

# the services of the binding, for callers that want a wide table
SERVICE_IDS = [f"svc_{i}_10.0.0.{j}:8080" for i in range(N_SERVER_NAMES) for j in range(N_IP_PORTS)]
LINK_NAMES = 5                       # linked series: user_id % 5
LINK_SHARE = 0.1                     # own share of a linked series

KEYS = ["ip_port", "server_name"]
METRICS = ["response_time", "qps", "eps"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def phase_split_ts():
    return F.lit(PHASE_SPLIT).cast("timestamp_ntz")


def metric_points(spark: SparkSession, sf_dir: str, bucket: str = METRIC_BUCKET,
                  start=None, end=None) -> DataFrame:
    """B1: service metrics per bucket (the 30 s MEAN of the reference, scaled).

    ``start``/``end`` ([start, end), bucket-aligned) bound the raw ``ts``
    before aggregating, so the bound is pushed into the parquet scan."""
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    if start is not None:
        ev = ev.filter(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        ev = ev.filter(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    return (ev
            .groupBy(
                F.concat(F.lit("10.0.0."), (F.col("user_id") % N_IP_PORTS).cast("string"),
                         F.lit(":8080")).alias("ip_port"),
                F.concat(F.lit("svc_"), (F.col("user_id") % N_SERVER_NAMES).cast("string")).alias("server_name"),
                F.window("ts", bucket).start.alias("ts"))
            .agg(F.count(F.lit(1)).cast("double").alias("connection_count"),
                 F.avg("value").alias("response_time"),
                 F.count_if(F.col("event_type") == "error").cast("double").alias("eps"))
            .withColumn("qps", F.col("connection_count")))


def with_service_id(df: DataFrame) -> DataFrame:
    """``service_id = ServerName + '_' + IP_port``."""
    return df.withColumn("service_id", F.concat_ws("_", "server_name", "ip_port"))


def phases(points: DataFrame):
    """B2: (baseline, problem) split by time of already aggregated points."""
    split = phase_split_ts()
    return points.filter(F.col("ts") < split), points.filter(F.col("ts") >= split)


def metric_phases(spark: SparkSession, sf_dir: str, bucket: str = METRIC_BUCKET):
    """B2 with the split applied to the raw timestamps: the split is
    bucket-aligned, so the buckets are identical to ``phases(metric_points)``,
    and each phase reads only its own part of the table (the bound is pushed
    into the parquet scan)."""
    return (metric_points(spark, sf_dir, bucket, end=PHASE_SPLIT),
            metric_points(spark, sf_dir, bucket, start=PHASE_SPLIT))


def as_phases(points):
    """Accept aggregated points or a ready (baseline, problem) pair."""
    return points if isinstance(points, tuple) else phases(points)


def edge_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call edges.  Per user ordered by (ts, event_id) the previous event
    type calls the current one; self-transitions are not calls.

    The events of a user with a large share of all events are spread over
    many tasks (see ``operators.series.previous_row``).
    """
    ev = (table(spark, sf_dir, "events")
          .select("event_id", "ts", "user_id", "event_type", "value",
                  F.get_json_object("props", "$.k").cast("int").alias("k")))
    with_prev = previous_row(ev, keys=["user_id"], order=["ts", "event_id"], cols=["event_type"])
    return (with_prev
            .filter(F.col("prev_event_type").isNotNull()
                    & (F.col("prev_event_type") != F.col("event_type")))
            .select("event_id", "ts", "user_id",
                    F.col("prev_event_type").alias("src"),
                    F.col("event_type").alias("dst"),
                    F.col("value").alias("rt"),
                    (F.col("k") >= ERROR_K).cast("double").alias("error"),
                    "k"))


def planted_edge_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call edges with a planted fault.  A call fails with ``k >= 98``; in
    the last PLANT_HOURS hours of the events every call on the PLANTED edges fails."""
    end = table(spark, sf_dir, "events").select(F.max("ts")).scalar()
    on_path = F.lit(False)
    for src, dst in PLANTED:
        on_path = on_path | ((F.col("src") == src) & (F.col("dst") == dst))
    burst = on_path & (F.col("ts") > end - F.expr(f"INTERVAL {PLANT_HOURS} HOURS"))
    return edge_points(spark, sf_dir).withColumn("error", ((F.col("k") >= PLANT_K) | burst).cast("double"))


def event_counters(spark: SparkSession, sf_dir: str, restart_days: int = 4) -> DataFrame:
    """Request counter per event type (event_type, ts, value), sampled
    hourly; the counter starts again from zero every ``restart_days`` days."""
    hourly = (table(spark, sf_dir, "events").select("ts", "event_type")
              .groupBy("event_type", F.window("ts", SCRAPE_STEP).end.alias("ts"))
              .agg(F.count(F.lit(1)).cast("double").alias("n")))
    run = F.floor(epoch_seconds("ts") / F.lit(restart_days * 86400))
    w = Window.partitionBy("event_type", run).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return hourly.select("event_type", "ts", F.sum("n").over(w).alias("value"))


def server_points(spark: SparkSession, sf_dir: str, bucket: str = METRIC_BUCKET) -> DataFrame:
    """Vmstat-like rows per server and bucket."""
    ev = (table(spark, sf_dir, "events")
          .select("ts", "user_id", "value",
                  F.get_json_object("props", "$.k").cast("int").alias("k")))
    sid = (F.col("user_id") % N_SERVERS).cast("int")
    types = F.array(*[F.lit(t) for t in SERVER_TYPES])
    return (ev.groupBy(sid.alias("server_id"), F.window("ts", bucket).start.alias("ts"))
            .agg(F.count(F.lit(1)).cast("double").alias("cpu_us"),
                 F.avg("value").alias("cpu_sy"),
                 F.max("value").alias("mem_free"),
                 F.avg("k").alias("io_bi"))
            .withColumn("type", F.element_at(types, (F.col("server_id") % len(SERVER_TYPES)) + 1)))


def linked_points(spark: SparkSession, sf_dir: str, bucket: str = METRIC_BUCKET) -> DataFrame:
    """Series that depend on each other by a known lag.  ``link_k`` at t is
    the load of user group 0 at ``t - k`` buckets plus a tenth of its own
    group's; ``shifted`` is group 0 plus 1e9, ``constant`` never changes."""
    load = (table(spark, sf_dir, "events").select("ts", "user_id")
            .groupBy((F.col("user_id") % LINK_NAMES).cast("int").alias("k"), F.window("ts", bucket).start.alias("ts"))
            .agg(F.count(F.lit(1)).cast("double").alias("x")))
    lead = load.filter("k = 0").select(F.col("ts").alias("t0"), F.col("x").alias("x0"))
    links = (load.withColumn("t0", F.col("ts") - F.make_dt_interval(hours=6 * F.col("k"))).join(lead, "t0")
             .select(F.concat(F.lit("link_"), F.col("k").cast("string")).alias("id"), "ts",
                     (F.col("x0") + LINK_SHARE * F.col("x")).alias("x")))
    return (links.unionByName(lead.select(F.lit("shifted").alias("id"), F.col("t0").alias("ts"),
                                          (F.col("x0") + 1e9).alias("x")))
            .unionByName(lead.select(F.lit("constant").alias("id"), F.col("t0").alias("ts"), F.lit(0.7).alias("x"))))


def planted_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linked and the constant series (id, ts, x, age) up to link_0's
    newest point, with a fault in the last steps (``age`` counts steps back from
    there): link_2 to link_4 rise by 1000 in their last 5 * k steps, link_1
    falls by 1000 in its last 5.  ``late`` is link_0 from the last FAULT_STEPS
    steps on, a series without history."""
    x = linked_points(spark, sf_dir)
    end = x.where("id = 'link_0'").select(F.max("ts")).scalar()
    age = F.floor((epoch_seconds(end) - epoch_seconds("ts")) / F.lit(6 * 3600))
    x = x.where((F.startswith("id", F.lit("link")) | (F.col("id") == "constant")) & (F.col("ts") <= end)) \
        .select("id", "ts", "x", age.alias("age"))
    k = F.when(F.startswith("id", F.lit("link")), F.substring("id", -1, 1).cast("int")).otherwise(0)
    shift = F.when(F.col("age") < 5 * k, F.when(k == 1, -1000.0).otherwise(1000.0)).otherwise(0.0)
    late = x.where((F.col("id") == "link_0") & (F.col("age") < FAULT_STEPS)).withColumn("id", F.lit("late"))
    return x.withColumn("x", F.col("x") + shift).unionByName(late)


def standby_points(spark: SparkSession, sf_dir: str, bucket: str = METRIC_BUCKET) -> DataFrame:
    """Services that take turns.  Over the buckets that have events,
    ``active`` reports in the even ones and ``standby`` in the odd ones,
    ``odd`` always (2 in odd buckets, else 1) and ``rare`` in every eighth."""
    ts = table(spark, sf_dir, "events").select(F.window("ts", bucket).start.alias("ts")).distinct()
    turn = F.floor(epoch_seconds("ts") / F.lit(6 * 3600))
    odd = turn % 2 == 1
    point = F.array(F.struct(F.when(odd, "standby").otherwise("active").alias("id"), F.lit(5.0).alias("x")),
                    F.struct(F.lit("odd").alias("id"), F.when(odd, 2.0).otherwise(1.0).alias("x")),
                    F.struct(F.when(turn % 8 == 3, "rare").alias("id"), F.lit(1.0).alias("x")))
    return ts.select("ts", F.explode(point).alias("p")).select("p.id", "ts", "p.x").where("id IS NOT NULL")


def trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed trade graph of nations: src sells to dst if its suppliers
    deliver more lines to dst's customers than an average pair's, by over
    TRADE_SIGMA population std."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    seller = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")) \
        .select("s_suppkey", F.col("n_name").alias("src"))
    buyer = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .select("c_custkey", F.col("n_name").alias("dst"))
    pairs = (table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
             .join(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
             .join(seller, F.col("l_suppkey") == F.col("s_suppkey")).join(buyer, F.col("o_custkey") == F.col("c_custkey"))
             .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))
    st = pairs.agg(F.avg("n").alias("m"), F.stddev_pop("n").alias("s")).first()
    if st["m"] is None:
        return pairs.select("src", "dst")
    return pairs.where((F.col("n") > F.lit(st["m"] + TRADE_SIGMA * st["s"])) & (F.col("src") != F.col("dst"))) \
        .select("src", "dst")


def dag_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Acyclic graph region -> nation -> supplier (node names prefixed)."""
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    supplier = table(spark, sf_dir, "supplier").select("s_name", "s_nationkey")
    rn = (region.join(nation, region.r_regionkey == nation.n_regionkey)
          .select(F.concat(F.lit("region:"), "r_name").alias("src"),
                  F.concat(F.lit("nation:"), "n_name").alias("dst")))
    ns = (nation.join(supplier, nation.n_nationkey == supplier.s_nationkey)
          .select(F.concat(F.lit("nation:"), "n_name").alias("src"),
                  F.concat(F.lit("supplier:"), "s_name").alias("dst")))
    return rn.unionByName(ns).distinct()


# ---------------------------------------------------------------- counters

def _hour_end(ts_col: str = "ts"):
    return F.window(ts_col, SCRAPE_STEP).end


def _cumulative(df: DataFrame, series: list[str], value: str) -> DataFrame:
    """Counter samples: running total per series over the hourly grid.  The
    input has one row per series and hour, so each series holds at most one
    row per hour of history."""
    w = Window.partitionBy(*series).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("value", F.sum(value).over(w)).drop(value)


def hourly_edge_stats(edges: DataFrame) -> DataFrame:
    """One pass over the call edges: per (src, dst, scrape hour) the request
    counts by status class, the count per latency bucket and the latency sum.
    Every counter below is derived from this small table (edges x hours), so
    the raw edges are scanned and shuffled once."""
    per_le = [F.count_if(F.col("rt") <= F.lit(le)).cast("double").alias(f"c{i}")
              for i, le in enumerate(LE_BOUNDS)]
    return (edges.groupBy("src", "dst", _hour_end().alias("ts"))
            .agg(F.count_if(F.col("error") <= 0).cast("double").alias("n200"),
                 F.count_if(F.col("error") > 0).cast("double").alias("n500"),
                 *per_le, F.sum("rt").alias("rt_sum")))


def requests_total(hourly: DataFrame) -> DataFrame:
    """Counter ``requests_total{src,dst,response_code}`` sampled hourly
    (a series has a sample in the hours it received requests)."""
    stacked = hourly.select("src", "dst", "ts", F.explode(F.array(
        F.struct(F.lit("200").alias("response_code"), F.col("n200").alias("n")),
        F.struct(F.lit("500").alias("response_code"), F.col("n500").alias("n")))).alias("r"))
    stacked = stacked.select("src", "dst", "r.response_code", "ts", "r.n").filter(F.col("n") > 0)
    return _cumulative(stacked, ["src", "dst", "response_code"], "n")


#: columns of duration_counters: the cumulative buckets and their bounds, the sum
BUCKETS = {f"c{i}": le for i, le in enumerate(LE_BOUNDS)}
DURATION_SUM = "rt_sum"


def duration_counters(hourly: DataFrame) -> DataFrame:
    """The counters of the latency histogram as columns of one row per edge
    and sample: running totals of every bucket and of the sum.  They are
    sampled together, so one window serves all."""
    w = Window.partitionBy("src", "dst").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return hourly.select("src", "dst", "ts", *[F.sum(c).over(w).alias(c) for c in (*BUCKETS, DURATION_SUM)])
