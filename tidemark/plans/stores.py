"""Queries on stores and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import stores
from tidemark.session import shared_folder
from tidemark.sources import standins

from .registry import query

GROUPS = "CASE WHEN user_id % 5 <> 4 THEN user_id % 5 END AS grp, CAST(date_trunc('month', ts) AS DATE) AS month"
PARTS = f"""
old AS (SELECT grp, month, string_agg(event_id || ' ' || value || event_type, ';' ORDER BY event_id) AS content FROM (SELECT *, {GROUPS} FROM events) WHERE event_id % 10 <> 3 GROUP BY 1, 2),
new AS (SELECT grp, month, string_agg(event_id || ' ' || value || event_type, ';' ORDER BY event_id) AS content FROM (SELECT *, {GROUPS} FROM events) WHERE event_id < 8000 OR event_id % 4 = 1 GROUP BY 1, 2)"""


def _events(spark, sf_dir):
    events = standins.table(spark, sf_dir, "events")
    group = F.when(F.col("user_id") % 5 != 4, F.col("user_id") % 5)  # one group has no key
    return events.select("event_id", group.alias("grp"), F.trunc(F.col("ts").cast("date"), "month").alias("month"), F.col("value"), "event_type")


@query(
    f"""WITH {PARTS} SELECT coalesce(a.grp, b.grp) AS grp, coalesce(a.month, b.month) AS month, CASE WHEN a.month IS NULL THEN 'added' WHEN b.month IS NULL THEN 'removed' ELSE 'changed' END AS state
    FROM old a FULL JOIN new b ON a.grp IS NOT DISTINCT FROM b.grp AND a.month = b.month WHERE a.content IS DISTINCT FROM b.content"""
)
def manifest_diff(spark, sf_dir):
    rows = _events(spark, sf_dir)
    of = lambda part: stores.manifest(part, ["grp", "month"], ["event_id", "value", "event_type"])
    return stores.manifest_diff(of(rows.where("event_id % 10 <> 3")), of(rows.where("event_id < 8000 or event_id % 4 = 1")), ["grp", "month"])


@query("SELECT event_id, event_type FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_id % 9 <> 0)")
def late_rows(spark, sf_dir):
    rows = _events(spark, sf_dir).select("event_id", "event_type")
    return stores.late(rows, rows.where("event_id % 9 <> 0"), "event_id")


@query(
    """SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'refused' WHEN event_id % 4 = 0 THEN 'kept published' ELSE 'dropped' END AS verdict,
    concat_ws(',', CASE WHEN event_id % 6 = 0 THEN 'value' END, CASE WHEN event_id % 4 = 0 THEN 'event_type' END) AS columns FROM events WHERE event_id % 2 = 0"""
)
def overlapping_pulls(spark, sf_dir):
    held = _events(spark, sf_dir).where("event_id % 2 = 0").select("event_id", "value", "event_type")
    kind = F.when(F.col("event_id") % 4 == 0, F.concat("event_type", F.lit("!"))).otherwise(F.col("event_type"))
    new = held.select("event_id", F.when(F.col("event_id") % 6 == 0, F.col("value") + 1).otherwise(F.col("value")).alias("value"), kind.alias("event_type"))
    return stores.overlapping(new, held, "event_id", ["event_type"])


@query(f"SELECT grp, month, count(*) AS n, sum(event_id) AS ids, min(event_type) AS least, round(sum(value), 4) AS total FROM (SELECT *, {GROUPS} FROM events) GROUP BY 1, 2")
def store_round_trip(spark, sf_dir):
    """Publish in two versions, the second with late rows, and read the current one."""
    import uuid

    root = f"{shared_folder(spark)}/store-{uuid.uuid4().hex[:12]}"
    rows = _events(spark, sf_dir)
    columns = ["event_id", "value", "event_type"]
    stores.publish(rows.where("event_id < 9000"), root, ["grp", "month"], columns)
    stores.publish(rows, root, ["grp", "month"], columns)
    current = stores.read_version(spark, root, ["grp", "month"])
    return current.groupBy("grp", "month").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.min("event_type").alias("least"), F.round(F.sum("value"), 4).alias("total"))
