"""Two of the batch jobs as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalframe.operators import models
from tidalframe.operators.models import Design
from tidalframe.plans.learners import LINES
from tidalframe.plans.registry import query
from tidalframe.session import scratch
from tidalframe.sources.tables import table
from tidalframe.streaming import jobs


@query(
    "stream_event_days",
    """SELECT event_type, CAST(ts AS DATE) AS date, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n
       FROM events GROUP BY 1, 2""",
)
def stream_event_days(spark: SparkSession, root: str) -> DataFrame:
    """Event totals per type and day from a stream equal those of the batch."""
    schema = table(spark, root, "events").schema
    stream = jobs.read_stream(spark, f"{root}/events.parquet", schema).select(
        "event_type", F.col("ts").cast("timestamp").alias("ts"), "value"
    )
    totals = jobs.windowed_totals(stream, "ts", ["event_type"], "value", late=None, scale=2)
    latest = jobs.run_updates(totals, "stream_event_days", ["event_type", "start"])
    return latest.select(
        "event_type", F.col("start").cast("date").alias("date"), "total", "n"
    )


@query(
    "stream_score_line",
    """WITH fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT l_orderkey, l_linenumber, round(a + b * l_quantity, 3) AS prediction FROM lineitem, fit""",
)
def stream_score_line(spark: SparkSession, root: str) -> DataFrame:
    """A fitted line scores a stream of lines as it scores the table."""
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    model = models.fit(Design("l_extendedprice", ("l_quantity",)), models.linear(), lines)
    stream = jobs.read_stream(spark, f"{root}/lineitem.parquet", lines.schema)
    scored = jobs.run_append(models.predict(model, stream, ["l_orderkey", "l_linenumber"]), "stream_score_line")
    return scored.withColumn("prediction", F.round("prediction", 3))


@query("stream_score")
def stream_score(spark: SparkSession, root: str) -> DataFrame:
    """A stored specification with nominal columns scores a stream of lines."""
    lines = table(spark, root, "lineitem")
    path = models.save(models.fit(LINES, models.elastic_net(200.0, 0.99), lines), scratch(spark, "stream_model"))
    stream = jobs.read_stream(spark, f"{root}/lineitem.parquet", lines.schema)
    return jobs.run_append(models.predict(models.load(path), stream, ["l_orderkey", "l_linenumber", "l_extendedprice"]), "stream_score")
