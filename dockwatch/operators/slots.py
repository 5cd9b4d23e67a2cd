"""Collections and repeated readings counted from bitmaps of time slots instead of distinct (station, time) tuples.

A station's readings set one bit per slot of the cadence; a bitmap covers 32,768 slots (about 22 days of minutes) in 4 kB. Only narrow
rows, one per station and slot, are shuffled and sorted; a bitmap is built where all rows of its station and stretch have
come together, and goes on at once into that of all stations, so a task holds two or three at a time. Times that lie on
a slot (the rule: one collection per slot) are exact in it; other times are counted by themselves, as tuples.
"""

from pyspark.sql import DataFrame, functions as F

#: Microseconds of a slot.
CADENCES = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000}


def slot_bitmaps(df: DataFrame, cadence: str = "minute", station="station_id", time="collected_at") -> DataFrame:
    """``bucket, station, n, on_slot, seen``: readings per station and stretch of slots, bits of the slots exactly met and of all slots.

    Rows without a time are left out.
    """
    unit = CADENCES[cadence]
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    rows = df.filter(F.col(time).isNotNull()).select(F.col(station).alias("station"), micros.alias("_micros"))
    rows = rows.select("station", F.expr(f"(_micros - pmod(_micros, {unit}L)) div {unit}L").alias("slot"), F.expr(f"pmod(_micros, {unit}L) = 0").alias("exact"))
    # readings of one slot are counted first, each task's own before the shuffle: a station with most of the readings is no heavy key
    met = rows.groupBy(F.bitmap_bucket_number("slot").alias("bucket"), "station", "slot", "exact").agg(F.count(F.lit(1)).alias("n"))
    bit = F.bitmap_bit_position("slot")
    # grouped by stretch first: the bitmaps come in that order, so that merging them needs no sort of bitmaps
    return met.repartition("bucket", "station").groupBy("bucket", "station").agg(
        F.sum("n").alias("n"), F.bitmap_construct_agg(F.when(F.col("exact"), bit)).alias("on_slot"),
        F.bitmap_construct_agg(bit).alias("seen"), F.min("slot").alias("first"), F.max("slot").alias("last"))


def collection_counts(df: DataFrame, cadence: str = "minute", station="station_id", time="collected_at") -> DataFrame:
    """One row: readings, distinct (station, time) tuples, slots from the first to the last collection, and slots with one.

    A reading without a time counts among the readings and tuples, as one tuple per station.
    """
    unit = CADENCES[cadence]
    bitmaps = slot_bitmaps(df, cadence, station, time)
    bitmaps = bitmaps.withColumn("met", F.bitmap_count("on_slot")).drop("on_slot", "station")
    per_stretch = bitmaps.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.sum("met").alias("tuples"), F.bitmap_or_agg("seen").alias("seen"),
        F.min("first").alias("first"), F.max("last").alias("last"))
    met = per_stretch.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("tuples"), F.lit(0)).alias("tuples"),
                          F.coalesce(F.sum(F.bitmap_count("seen")), F.lit(0)).alias("seen"), F.coalesce(F.max("last") - F.min("first") + 1, F.lit(0)).alias("every"))
    # times between slots and missing times, by themselves
    odd = df.filter(F.col(time).isNull() | (F.pmod(F.unix_micros(F.col(time).cast("timestamp")), F.lit(unit)) != 0))
    odd = odd.groupBy(station, time).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("odd"), F.coalesce(F.sum(F.when(F.col(time).isNull(), F.col("n"))), F.lit(0)).alias("timeless"))
    return met.crossJoin(odd).select(
        (F.col("n") + F.col("timeless")).cast("bigint").alias("readings"), (F.col("tuples") + F.col("odd")).cast("bigint").alias("tuples"),
        F.col("every").cast("bigint").alias("expected"), (F.col("every") - F.col("seen")).cast("bigint").alias("missing"))
