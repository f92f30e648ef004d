"""Events through the layers, as queries: into a first one by streams, into a second one by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.operators.upsert import upsert
from signalwatch.storage import fresh_path
from signalwatch.streaming import events
from signalwatch.streaming.events import Layer

#: Of the queries: every so many events' rows are held back and arrive with the second load.
HELD_BACK = 7
#: Every so many events arrive in both loads.
TWICE = 10


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return events.event_rows(spark.read.parquet(f"{folder}/events.parquet"))


def _totals(part: str, rows: DataFrame) -> DataFrame:
    """Number and value of events by hour and type."""
    return rows.groupBy(F.date_trunc("hour", "ts").alias("window_start"), "event_type").agg(
        F.count("*").alias("n_events"), F.sum("value").alias("total_value")) \
        .select(F.lit(part).alias("part"), "*")


def _text(time: str) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm").alias(time)


def bronze_events(spark: SparkSession, folder: str) -> DataFrame:
    """All events, landed in two loads and ingested after each.

    The first load has the earlier half of the time; some of its events are held back and come with the
    second load, mostly too late. The second load also repeats the first one's last hour. ``part`` is
    ``bronze`` (events by hour), ``late`` (events that were set aside) or ``closed`` (windows appended).
    """
    layer = Layer(fresh_path(spark, "events"))
    rows = _events(spark, folder)
    at = F.unix_micros("ts")
    first, last = rows.agg(F.min(at), F.max(at)).first()
    cut = 0 if first is None else first + (last - first) // 2
    held = F.col("event_id") % HELD_BACK == 0
    events.land(rows.where((at < cut) & ~held), layer)
    events.ingest(spark, layer)
    repeated = rows.where((at < cut) & (at >= cut - 3_600_000_000) & ~held)
    events.land(rows.where((at >= cut) | held).union(repeated), layer)
    events.ingest(spark, layer)
    closed = events.read_windows(spark, layer).select(F.lit("closed").alias("part"), "*")
    return (
        _totals("bronze", events.read_bronze(spark, layer))
        .union(_totals("late", events.read_late(spark, layer))).union(closed)
        .select("part", _text("window_start"), "event_type", "n_events",
                F.round("total_value", 6).alias("total_value"))
    )


def silver_events(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's latest event of each type, after two batches that know nothing of each other's
    times; some events come in both. Of events at one time, the one of the greatest id is the latest."""
    path = fresh_path(spark, "silver")
    rows = _events(spark, folder)
    even, both = F.col("event_id") % 2 == 0, F.col("event_id") % TWICE == 0
    keys, order = ["user_id", "event_type"], ["ts", "event_id"]
    upsert(spark, path, rows.where(even), keys, order)
    stored = upsert(spark, path, rows.where(~even | both), keys, order)
    return stored.select("user_id", "event_type", "event_id",
                         F.unix_micros("ts").alias("at_micros"), "value", "props")


QUERIES = {"bronze_events": bronze_events, "silver_events": silver_events}

SQL = {
    "bronze_events": f"""
        WITH e AS (
            SELECT *, epoch_us(ts) AS micros, event_id % {HELD_BACK} = 0 AS held FROM events),
        span AS (SELECT min(micros) + (max(micros) - min(micros)) // 2 AS cut, max(micros) AS newest FROM e),
        horizon AS (
            SELECT max(micros) - 2 * 3600000000 AS h FROM e, span WHERE micros < cut AND NOT held),
        judged AS (SELECT e.*, held AND micros < h AS late FROM e, span, horizon),
        totals AS (
            SELECT late, date_trunc('hour', ts) AS w, event_type, count(*) AS n_events,
                   round(sum(value), 6) AS total_value
            FROM judged GROUP BY ALL),
        parts AS (
            SELECT CASE WHEN late THEN 'late' ELSE 'bronze' END AS part, * FROM totals
            UNION ALL
            SELECT 'closed', totals.* FROM totals, span
            WHERE NOT late AND epoch_us(w) + 3600000000 <= newest - 2 * 3600000000)
        SELECT part, strftime(w, '%Y-%m-%d %H:%M') AS window_start, event_type, n_events, total_value
        FROM parts""",
    "silver_events": """
        SELECT user_id, event_type, event_id, epoch_us(ts) AS at_micros, value, props FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY ts DESC, event_id DESC) = 1""",
}
