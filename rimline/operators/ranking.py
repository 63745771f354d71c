"""The first rows per key, by an explicit order."""

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """Keep the first ``n`` rows of every key.

    Spark limits each key to its best rows before the shuffle as well as after it, so a key
    that holds a large part of all rows sends at most ``n`` rows per input partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")
