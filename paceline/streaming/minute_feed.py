"""The minute feed as a stream: each poll is merged into the archive of its local day, whatever order files arrive in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import clock
from ..lineage import scratch, written
from ..operators.cleaning import merge_polls
from ..sources.files import MINUTE_SCHEMA


def normalise(raw: DataFrame, zone: str) -> DataFrame:
    """Published rows with their types and local day."""
    named = raw.withColumn("sensing_date", F.to_date(clock.to_local(F.col("sensing_datetime").cast("timestamp_ntz"), zone)))
    return named.select(*[F.col(p.split()[0]).cast(p.split()[1]) for p in MINUTE_SCHEMA.split(", ")])


def merge_into(archive: str, polls: DataFrame) -> int:
    """Merge rows into their days and return how many days changed.

    A day is rewritten as a whole, in a folder of its own that replaces the old one only when it is complete, so a
    batch that is run again changes nothing. Days without new rows, or earlier polls of held ones, aren't touched.
    """
    spark = polls.sparkSession
    polls = polls.persist()
    try:
        days = polls.select("sensing_date").distinct()
        try:
            held = spark.read.schema(MINUTE_SCHEMA).parquet(archive)
        except AnalysisException:
            held = spark.createDataFrame([], MINUTE_SCHEMA)
        old = held.join(days, "sensing_date", "left_semi").select(*held.columns)
        merged = merge_polls(old, polls.select(*held.columns)).select(*held.columns)
        fresh = merged.exceptAll(old.distinct()).select("sensing_date").distinct()
        with scratch(spark):
            # written in full, by a name of its own, before what it is read from is replaced
            staged = written(merged.join(fresh, "sensing_date", "left_semi").select(*held.columns), "polls")
            changed = staged.select("sensing_date").distinct().count()
            if changed:
                staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sensing_date").parquet(archive)
        return changed
    finally:
        polls.unpersist()


def run(spark: SparkSession, source: str, archive: str, checkpoint: str, zone: str):
    """Take in all polls that are there, then stop; call it again for what comes later."""
    raw = spark.readStream.schema("location_id long, sensing_datetime timestamp_ntz, direction_1 long, direction_2 long, total_of_directions long, polled_at timestamp_ntz").parquet(source)
    stream = normalise(raw, zone).writeStream.foreachBatch(lambda batch, _: merge_into(archive, batch)).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()


def block_counts(stream: DataFrame, minutes: int = 5, late: str = "1 hour") -> DataFrame:
    """Sums of each sensor's blocks as they come; rows later than `late` are left to the archive."""
    own = stream.withColumn("ts", F.col("sensing_datetime").cast("timestamp")).withWatermark("ts", late)
    return own.groupBy(F.window("ts", f"{minutes} minutes"), "location_id").agg(F.sum("total_of_directions").alias("total")).select(F.col("window.start").alias("block"), "location_id", "total")


def poll_since(spark: SparkSession, now: str) -> DataFrame:
    """From when a poll asks for rows: everything in the first quarter of an hour, else the last three hours."""
    ts = F.lit(now).cast("timestamp_ntz")
    return spark.range(1).select(F.when(F.minute(ts) >= 15, F.timestamp_add("HOUR", F.lit(-3), ts)).alias("since"))
