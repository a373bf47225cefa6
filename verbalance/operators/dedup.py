"""One row per key."""

from pyspark.sql import Window
from pyspark.sql import functions as F


def first_per_key(df, key, order):
    """The first row of each key in a total ``order``.

    The rank limit runs before the shuffle as well, so a map task sends on at
    most one row per key however many copies it reads.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_records(bronze, base_name):
    """The last record written for each base name; records without a name are all kept."""
    # Records without a name are keys of their own, so that one scan serves both kinds.
    named = bronze.withColumn("base_name", base_name).withColumn(
        "_own", F.when(F.col("base_name").isNull(), F.monotonically_increasing_id())
    )
    order = [
        F.desc_nulls_last("processing_timestamp"),
        F.desc_nulls_last("batch_id"),
        F.desc_nulls_last("audio_filename"),
    ]
    return first_per_key(named, ["base_name", "_own"], order).drop("_own")
