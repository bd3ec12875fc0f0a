"""Risk alerts over the published parties. Works alike on a stream and on a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from entigrid.fixed_values import ALERT_THRESHOLD
from entigrid.operators.rule_tables import read_rules, with_rules


def route_alerts(records: DataFrame) -> DataFrame:
    """Level and message per record; an absent or malformed score counts as 0."""
    score = F.coalesce(F.col("risk_score").cast("string").try_cast("int"), F.lit(0))
    routed = records.withColumn("risk_score", score).withColumn(
        "level", F.when(F.col("risk_score") >= ALERT_THRESHOLD, "ALERT").otherwise("OK")
    )
    alert = F.format_string(
        "ALERT: High-risk party %s (%s) risk score %d", "id", "name", "risk_score"
    )
    ok = F.format_string("Party %s risk score %d (ok)", "id", "risk_score")
    message = F.when(F.col("level") == "ALERT", alert).otherwise(ok).alias("message")
    ruled = [c for c in ("tier", "frameworks", "rules_version") if c in records.columns]
    return routed.select("id", "name", "risk_score", "level", message, *ruled)


def alerts_only(records: DataFrame) -> DataFrame:
    return route_alerts(records).filter(F.col("level") == "ALERT")


def start_alerts(
    records: DataFrame,
    output: str,
    checkpoint: str,
    interval: str | None = None,
    alerts: str | None = None,
    rules: str | None = None,
) -> StreamingQuery:
    """Route a stream to ``output``, and the alerts among it to ``alerts``; the checkpoint is the
    durable position.

    Without an interval it handles what is there and stops, and a later start goes on from there.
    Every batch has a folder of its own in both outputs, named by the stream and the batch's
    number, and replaces what it finds there. So a batch that is handled again, because its end
    was not recorded, adds nothing twice. ``rules`` names rule versions: each batch goes by those
    in effect when it is handled.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        place = f"stream={stream}/batch={number}"
        ruled = with_rules(batch, read_rules(spark, rules)) if rules else batch
        route_alerts(ruled).write.mode("overwrite").parquet(f"{output}/{place}")
        if alerts:
            # from what was written, so that both outputs tell the same
            routed = spark.read.parquet(f"{output}/{place}")
            routed.filter("level = 'ALERT'").write.mode("overwrite").parquet(f"{alerts}/{place}")

    writer = records.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
