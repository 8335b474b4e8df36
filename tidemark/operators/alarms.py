"""Metric series and threshold alarms.

A metric frame has `metric`, `period` (start) and `value`, one row per period
that had data. It holds a few rows per minute, however large the events are.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import timing
from tidemark.schema import ALARM_RULES


def series(df: DataFrame, metric: str, ts: str, value, period_seconds: int = 60) -> DataFrame:
    """One metric from an aggregate per fixed period."""
    return (
        df.groupBy(timing.floor_period(F.col(ts), period_seconds).alias("period"))
        .agg(value.cast("double").alias("value"))
        .select(F.lit(metric).alias("metric"), "period", "value")
    )


def fill_gaps(metric_rows: DataFrame, period_seconds=60) -> DataFrame:
    """Add a zero row for every missing period between a metric's first and last.

    Each row is followed by the zeros up to the next one, so the series is
    read once and not joined with itself.
    """
    step = timing.seconds(period_seconds)
    following = F.lead("period").over(Window.partitionBy("metric").orderBy("period"))
    last = F.coalesce(following - step, F.col("period"))
    spread = metric_rows.withColumn("_each", F.sequence("period", last, step))
    others = [c for c in metric_rows.columns if c not in ("metric", "period", "value")]
    return spread.select("metric", *others, F.posexplode("_each").alias("_n", "_at"), "value").select(
        "metric",
        *others,
        F.col("_at").alias("period"),
        F.when(F.col("_n") == 0, F.col("value")).otherwise(F.lit(0.0)).alias("value"),
    )


def breaches(metric_rows: DataFrame, threshold: float, consecutive: int = 1) -> DataFrame:
    """Add `breached`: this period and those before it, `consecutive` in all,
    are over the threshold. Needs a series without gaps."""
    return metric_rows.withColumn("breached", _breached(F.lit(float(threshold)), consecutive))


def _breached(threshold, consecutive: int):
    recent = Window.partitionBy("metric").orderBy("period").rowsBetween(-(consecutive - 1), 0)
    enough = F.count("value").over(recent) == consecutive
    return enough & (F.min("value").over(recent) > threshold)


def alarm(metric_rows: DataFrame, threshold: float, consecutive: int = 1, period_seconds: int = 60) -> DataFrame:
    """Gap-filled series with `breached` per period."""
    return breaches(fill_gaps(metric_rows, period_seconds), threshold, consecutive)


def alarm_table(metric_rows: DataFrame, rules=ALARM_RULES) -> DataFrame:
    """Per rule and metric: periods, breached periods, worst value, first and last breach.

    `metric` may carry a dimension after a '/', as in
    `records_per_second_per_shard/shard-3`; each is judged by itself. All rules
    are judged in one pass over the series.
    """
    name = F.substring_index("metric", "/", 1)

    def of_rule(position):
        pairs = [F.lit(x) for rule in rules for x in (rule[0], rule[position])]
        return F.create_map(*pairs)[name]

    ruled = metric_rows.where(name.isin([rule[0] for rule in rules])).withColumns(
        {"threshold": of_rule(1), "consecutive": of_rule(3), "_seconds": of_rule(2)}
    )
    judged = fill_gaps(ruled, F.col("_seconds")).drop("_seconds")
    # One verdict per run length in use; each row takes the one of its rule.
    lengths = sorted({rule[3] for rule in rules})
    verdict = F.lit(False)
    for length in lengths:
        verdict = F.when(F.col("consecutive") == length, _breached(F.col("threshold"), length)).otherwise(verdict)
    judged = judged.withColumn("breached", verdict)
    breach_time = F.when(F.col("breached"), F.col("period"))
    return judged.groupBy("metric", "threshold", "consecutive").agg(
        F.count(F.lit(1)).alias("periods"),
        F.count_if("breached").alias("breached_periods"),
        F.max("value").alias("worst_value"),
        F.min(breach_time).alias("first_breach"),
        F.max(breach_time).alias("last_breach"),
    )
