"""Keeping or dropping rows by a set of keys, when a key may be very frequent."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 16


def matched(rows: DataFrame, keys: DataFrame, on: str, spread: int = 0) -> DataFrame:
    """Rows whose key is among the keys."""
    return _join(rows, keys, on, "left_semi", spread)


def unmatched(rows: DataFrame, keys: DataFrame, on: str, spread: int = 0) -> DataFrame:
    """Rows whose key is not among the keys."""
    return _join(rows, keys, on, "left_anti", spread)


def _join(rows, keys, on, how, spread):
    """With `spread`, rows of one key go to that many tasks and every key to
    all of them. Which task a row goes to does not change the result, so the
    number of its input partition will do. AQE alone is no help here: equal
    keys compress so well that their partition does not look large. The merge
    hint is there because Spark's size estimate leaves out the copies of the
    keys and would broadcast them.
    """
    if not spread:
        return rows.join(keys.select(on), on, how).select(*rows.columns)
    salted = rows.withColumn("_salt", F.spark_partition_id() % F.lit(spread))
    everywhere = keys.select(on, F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_salt"))
    return salted.join(everywhere.hint("merge"), [on, "_salt"], how).select(*rows.columns)
