"""As-of reference lookup: the version in force at each collection time, then its station rows."""

from pyspark.sql import DataFrame, Window, functions as F

from dockwatch.session import materialise


def asof_version(times: DataFrame, versions: DataFrame, time="collected_at", version="version_ts",
                 fallback: bool = False) -> DataFrame:
    """Each distinct time with the greatest version at or before it (NULL when there is none).

    With ``fallback`` a time before the first version takes the first version.

    Both lists are merged and scanned in time order, one hour at a time, so the work is linear and
    no (time, version) pairs are formed. What an hour inherits from earlier hours of its day is found on one row per
    hour, what a day inherits on one row per day; the latter is the only unpartitioned window. The distinct times are
    stored, so the readings are read once.
    """
    when = materialise(times.select(F.col(time).alias("at")).filter(F.col(time).isNotNull()).distinct(), "times")
    known = materialise(versions.select(F.col(version).alias("at")).filter(F.col(version).isNotNull()).distinct(), "known")
    points = known.select("at", F.col("at").alias("v"), F.lit(0).alias("kind")).unionByName(
        when.select("at", F.lit(None).cast(known.schema["at"].dataType).alias("v"), F.lit(1).alias("kind"))
    ).withColumn("day", F.to_date("at")).withColumn("slot", F.date_trunc("hour", "at"))

    in_hour = Window.partitionBy("slot").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    same_hour = points.withColumn("v", F.last("v", ignorenulls=True).over(in_hour)).filter("kind = 1")
    earlier_hours = Window.partitionBy("day").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    hours = points.groupBy("day", "slot").agg(F.max("v").alias("hour_last")).select(
        "slot", F.last("hour_last", ignorenulls=True).over(earlier_hours).alias("from_hours"))
    same_day = same_hour.join(hours, "slot")

    # one row per day: bounded by the calendar, whatever the volume of readings
    days = points.groupBy("day").agg(F.max("v").alias("day_last"), F.min("v").alias("day_first"))
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    overall = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = days.select(
        "day",
        F.last("day_last", ignorenulls=True).over(before).alias("carried"),
        F.min("day_first").over(overall).alias("earliest"),
    )
    picks = [F.col("v"), F.col("from_hours"), F.col("carried")] + ([F.col("earliest")] if fallback else [])
    return same_day.join(carried, "day").select(F.col("at").alias(time), F.coalesce(*picks).alias(version))


def attach_reference(readings: DataFrame, reference: DataFrame, picks: DataFrame = None) -> DataFrame:
    """Left join of the reference rows on (version, station code).

    ``picks`` (collection time -> version) is joined first when given; a reading without a
    collection time belongs to no collection and is left out there. Whole collections may
    come without a station code; those rows can never match, so each gets a key of its own
    instead of meeting all the others in one task.
    """
    if picks is not None:
        readings = readings.join(picks, "collected_at")
    own_key = F.concat(F.lit("\u0000"), F.col("row_id").cast("string"))
    lost = F.col("version_ts").isNull() | F.col("station_code").isNull()
    keyed = readings.withColumn("join_code", F.when(lost, own_key).otherwise(F.col("station_code")))
    known = reference.filter(F.col("station_code").isNotNull()).withColumnRenamed("station_code", "join_code")
    return keyed.join(known, ["version_ts", "join_code"], "left").drop("join_code")
