"""Telemetry queries over events, orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from revtide.operators.telemetry import (
    OUTCOME_OF,
    abandoned_operations,
    duration_histogram,
    duration_percentiles,
    duration_sketches,
    latest_status,
    operation_counts,
    outcome_label,
    rejected_observations,
)
from revtide.plans.registry import query
from revtide.plans.tables import table
from revtide.session import scratch_dir
from revtide.streaming.keyed import abandoned_operations_stream, use_keyed_state

BOUNDS = (1.0, 5.0, 10.0, 50.0, 100.0, 500.0)
RESULTS = (*OUTCOME_OF, "odd")


def _observations(spark, sf_dir, *more):
    """Every event as a host observation; the result class comes from the user id."""
    e = F.col("event_type")
    operation = (
        F.when(e == "click", "action")
        .when(e == "view", "query")
        .when(e == "purchase", "work")
        .when(e == "signup", "recovery")
        .otherwise("action")
    )
    results = F.array(*[F.lit(r) for r in RESULTS])
    result = F.when(e == "error", "storage").otherwise(
        F.get(results, (F.col("user_id") % len(RESULTS)).cast("int"))
    )
    return table(spark, sf_dir, "events").select(
        operation.alias("operation"), result.alias("result"), F.col("value").alias("duration_s"), *more
    )


_RESULT_LIST = ", ".join(f"'{r}'" for r in RESULTS)
_OUTCOME_LIST = ", ".join(f"'{OUTCOME_OF.get(r, 'rejected')}'" for r in RESULTS)
_OBSERVED_SQL = f"""
  SELECT CASE event_type WHEN 'click' THEN 'action' WHEN 'view' THEN 'query'
           WHEN 'purchase' THEN 'work' WHEN 'signup' THEN 'recovery' ELSE 'action' END AS operation,
         CASE WHEN event_type = 'error' THEN 'failed'
              ELSE ([{_OUTCOME_LIST}])[user_id % {len(RESULTS)} + 1] END AS outcome,
         value AS duration_s
  FROM events
"""


@query(
    "operation_counts",
    f"SELECT operation, outcome, count(*) AS n FROM ({_OBSERVED_SQL}) GROUP BY 1, 2",
)
def count_operations(spark, sf_dir):
    return operation_counts(_observations(spark, sf_dir))


_BUCKETS = ", ".join(
    f"count(*) FILTER (duration_s <= {b}) AS le_{n}" for n, b in enumerate(BOUNDS)
)


@query(
    "duration_histogram",
    f"""SELECT operation, outcome, count(*) AS n, round(sum(duration_s), 2) AS total_s, {_BUCKETS}
    FROM ({_OBSERVED_SQL}) GROUP BY 1, 2""",
)
def histogram(spark, sf_dir):
    out = duration_histogram(_observations(spark, sf_dir), BOUNDS)
    return out.withColumn("total_s", F.round("total_s", 2))


@query(
    "observations_rejected",
    """SELECT reject_reason, count(*) AS n FROM (
      SELECT CASE WHEN event_id % 37 = 3 THEN 'unknown_operation' WHEN event_id % 31 = 2 THEN 'duration_invalid' END
        AS reject_reason FROM events) WHERE reject_reason IS NOT NULL GROUP BY 1""",
)
def observations_rejected(spark, sf_dir):
    """Observations that counts and histogram leave out are counted by reason."""
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(
        F.when(k % 37 == 3, "other").otherwise("query").alias("operation"),
        F.when(k % 31 == 2, F.when(k % 2 == 0, float("nan")).otherwise(-1.0)).otherwise(F.abs("value")).alias("duration_s"),
    )
    return rejected_observations(rows)


@query(
    "latest_status",
    """WITH s AS (SELECT event_id AS ts, event_type <> 'error' AND event_id % 41 <> 5 AS good, *
      FROM events),
    g AS (SELECT * FROM s WHERE good ORDER BY ts DESC LIMIT 1)
    SELECT 'ready' AS instrument, '' AS label, CAST(value > 20 AS BIGINT) AS value FROM g
    UNION ALL SELECT 'failed', '', CAST(value > 200 AS BIGINT) FROM g
    UNION ALL SELECT 'intake', 'open', CAST(event_id % 3 = 0 AS BIGINT) FROM g
    UNION ALL SELECT 'intake', 'draining', CAST(event_id % 3 = 1 AS BIGINT) FROM g
    UNION ALL SELECT 'intake', 'stopped', CAST(event_id % 3 = 2 AS BIGINT) FROM g
    UNION ALL SELECT 'owned_work', '', user_id FROM g
    UNION ALL SELECT 'permits', 'action', event_id % 64 FROM g
    UNION ALL SELECT 'permits', 'io', event_id % 32 FROM g
    UNION ALL SELECT 'permits', 'subscription', event_id % 16 FROM g
    UNION ALL SELECT 'registered', 'resource', 7 FROM g
    UNION ALL SELECT 'registered', 'reaction', 3 FROM g
    UNION ALL SELECT 'registered', 'channel', 2 FROM g
    UNION ALL SELECT 'available', '', CAST(arg_max(good, ts) AS BIGINT) FROM s
    UNION ALL SELECT 'status_failures', '', count(*) FILTER (NOT good) FROM s""",
)
def last_status(spark, sf_dir):
    """Events as status samples; an error is a failed one, some counts are out of range."""
    k = F.col("event_id")
    intake = F.when(k % 3 == 0, "open").when(k % 3 == 1, "draining").otherwise("stopped")
    samples = table(spark, sf_dir, "events").select(
        k.alias("ts"),
        (F.col("event_type") != "error").alias("ok"),
        (F.col("value") > 20).alias("ready"),
        (F.col("value") > 200).alias("failed"),
        intake.alias("intake"),
        F.when(k % 41 == 5, -1).otherwise(F.col("user_id")).alias("owned_work"),
        (k % 64).alias("action_permits"),
        (k % 32).alias("io_permits"),
        (k % 16).alias("subscription_permits"),
        F.lit(7).alias("registered_resources"),
        F.lit(3).alias("registered_reactions"),
        F.lit(2).alias("registered_channels"),
    )
    return latest_status(samples)


@query(
    "duration_percentiles",
    f"""SELECT operation, outcome, n, share, true AS close FROM (
      SELECT operation, outcome, count(*) AS n FROM ({_OBSERVED_SQL}) GROUP BY 1, 2),
      (SELECT unnest([0.5, 0.9, 0.99])::DOUBLE AS share)""",
)
def percentiles(spark, sf_dir):
    """Percentiles from hourly sketches; ``close`` if the exact rank is off by 1 % at most."""
    rows = _observations(spark, sf_dir, F.expr("event_id div 360").alias("hour"))
    found = duration_percentiles(duration_sketches(rows), [0.5, 0.9, 0.99])
    # A few dozen groups of three.
    own = rows.withColumn("outcome", outcome_label(F.col("result"))).select("operation", "outcome", F.col("duration_s").alias("_d"))
    ranked = (
        own.join(F.broadcast(found), ["operation", "outcome"])
        .groupBy("operation", "outcome", "n", "share")
        .agg(F.count_if(F.col("_d") < F.col("duration_s")).alias("_below"), F.count_if(F.col("_d") <= F.col("duration_s")).alias("_upto"))
    )
    near = (F.col("_below") / F.col("n") <= F.col("share") + 0.01) & (F.col("_upto") / F.col("n") >= F.col("share") - 0.01)
    return ranked.select("operation", "outcome", "n", "share", near.alias("close"))


@query(
    "abandoned_operations",
    """WITH s AS (SELECT o_orderkey AS observation, o_orderkey % 4 AS m,
        o_orderkey * 13 % 100000 AS ts FROM orders),
    f AS (SELECT l_orderkey AS observation, min((l_orderkey * 13 % 100000
          + l_partkey % 900)) AS ts FROM lineitem GROUP BY 1),
    r AS (SELECT l_orderkey AS observation, min(l_returnflag) AS flag FROM lineitem l
      JOIN f ON f.observation = l_orderkey AND f.ts = l_orderkey * 13 % 100000 + l_partkey % 900
      GROUP BY 1)
    SELECT s.observation, (['action', 'query', 'work', 'recovery'])[m + 1] AS operation,
      CASE WHEN f.ts - s.ts <= 300
             THEN CASE flag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'denied' ELSE 'rejected' END
           WHEN 99000 - s.ts > 300 THEN 'abandoned' ELSE 'open' END AS outcome
    FROM s LEFT JOIN f USING (observation) LEFT JOIN r USING (observation)""",
)
def lost_operations(spark, sf_dir):
    """Orders as started observations, line items as (repeated) finishes."""
    return abandoned_operations(*_observed(spark, sf_dir), 300, 99000)


def _observed(spark, sf_dir):
    names = F.array(*[F.lit(o) for o in ("action", "query", "work", "recovery")])
    starts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("observation"),
        F.get(names, (F.col("o_orderkey") % 4).cast("int")).alias("operation"),
        (F.col("o_orderkey") * 13 % 100000).alias("ts"),
    )
    flag = F.col("l_returnflag")
    finishes = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("observation"),
        # Result names sort as the flags do, so equal times are settled alike in SQL.
        F.when(flag == "A", "accepted").when(flag == "N", "denied").otherwise("rare").alias("result"),
        (F.col("l_orderkey") * 13 % 100000 + F.col("l_partkey") % 900).alias("ts"),
    )
    return starts, finishes


@query(
    "abandoned_operations_stream",
    """WITH s AS (SELECT o_orderkey AS observation, o_orderkey % 4 AS m, o_orderkey * 13 % 100000 AS ts FROM orders),
    f AS (SELECT l_orderkey AS observation, min(l_orderkey * 13 % 100000 + l_partkey % 900) AS ts FROM lineitem GROUP BY 1),
    r AS (SELECT l_orderkey AS observation, min(l_returnflag) AS flag FROM lineitem l
      JOIN f ON f.observation = l_orderkey AND f.ts = l_orderkey * 13 % 100000 + l_partkey % 900 GROUP BY 1)
    SELECT s.observation, (['action', 'query', 'work', 'recovery'])[m + 1] AS operation,
      CASE WHEN f.ts - s.ts <= 300
             THEN CASE flag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'denied' ELSE 'rejected' END
           ELSE 'abandoned' END AS outcome
    FROM s LEFT JOIN f USING (observation) LEFT JOIN r USING (observation)""",
)
def lost_operations_stream(spark, sf_dir):
    """The same as a stream, every start twice, until its last timer has run out."""
    path = scratch_dir(spark, "lost")
    starts, finishes = _observed(spark, sf_dir)
    end = [("end", "end", 10**6)] * 2
    for name, frame in (("starts", starts.unionAll(starts)), ("finishes", finishes)):
        # A stream's watermark begins at second 0, so the day begins after it.
        timed = frame.withColumns({"observation": F.col("observation").cast("string"), "ts": F.timestamp_seconds(F.col("ts") + 3600)})
        timed.coalesce(1).write.parquet(f"{path}/{name}")
        # Two later files move the watermark past every timer.
        for row in end:
            last = spark.createDataFrame([row], timed.columns).withColumn("ts", F.timestamp_seconds("ts"))
            last.coalesce(1).write.mode("append").parquet(f"{path}/{name}")
    use_keyed_state(spark)
    streams = [
        spark.readStream.schema(spark.read.parquet(f"{path}/{n}").schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/{n}")
        for n in ("starts", "finishes")
    ]
    lost = abandoned_operations_stream(*streams, 300)
    job = lost.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
    job.trigger(availableNow=True).start().awaitTermination()
    seen = spark.read.schema("observation string, operation string, ts long, outcome string").parquet(f"{path}/out")
    return seen.filter("observation <> 'end'").select(F.col("observation").cast("long").alias("observation"), "operation", "outcome")
