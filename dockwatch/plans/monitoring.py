"""Figures that watch the jobs: run totals, loss, freshness, backlog, message rates and errors."""

from pyspark.sql import DataFrame, Window, functions as F

# fixed values: warning bands
CLEAN_BANDS = (80.0, 95.0)      # red below the first, orange below the second, else green
AGE_BANDS = (300, 900)          # green below the first second, orange below the second, else red


def run_totals(runs: DataFrame) -> DataFrame:
    """Runs, raw, rejected, duplicate and loaded rows, and the end of the last run in Unix seconds."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("rows_raw", "rows_rejected", "rows_duplicate", "rows_loaded")]
    last = F.coalesce(F.unix_timestamp(F.max("ended_at")), F.lit(0)).cast("bigint")
    return runs.agg(F.count(F.lit(1)).alias("runs"), *sums, last.alias("last_run"))


def clean_ratio(runs: DataFrame) -> DataFrame:
    """Loaded rows as a share of the rows read, with its band."""
    totals = runs.agg(F.sum("rows_loaded").alias("loaded"), F.sum("rows_raw").alias("raw"))
    ratio = F.round(F.lit(100.0).cast("double") * F.col("loaded") / F.nullif(F.col("raw"), F.lit(0)), 2)
    band = F.when(F.col("clean_pct") < CLEAN_BANDS[0], "red").when(F.col("clean_pct") < CLEAN_BANDS[1], "orange").when(
        F.col("clean_pct").isNotNull(), "green")
    return totals.select(ratio.alias("clean_pct")).withColumn("band", band)


def run_age(runs: DataFrame, now) -> DataFrame:
    """Seconds since the last run ended, with its band; ``now`` is a time value or Column."""
    now = now if hasattr(now, "cast") else F.lit(now)
    age = F.unix_timestamp(now) - F.unix_timestamp(F.max("ended_at"))
    band = F.when(F.col("age_s") < AGE_BANDS[0], "green").when(F.col("age_s") < AGE_BANDS[1], "orange").when(
        F.col("age_s").isNotNull(), "red")
    return runs.agg(age.cast("bigint").alias("age_s")).withColumn("band", band)


def pending(zones: DataFrame, runs: DataFrame, zone: str = "aggregated") -> DataFrame:
    """Records of a zone that no run has read yet."""
    stored = zones.filter(F.col("zone") == zone).select(F.col("records").alias("n"))
    read = runs.select((-F.col("rows_raw")).alias("n"))
    return stored.unionByName(read).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("pending"))


def source_errors(errors: DataFrame) -> DataFrame:
    """Errors per source and whether that is acceptable."""
    return errors.groupBy("source").agg(F.sum("errors").cast("bigint").alias("errors")).withColumn("healthy", F.col("errors") < 1)


def cumulative_counts(runs: DataFrame) -> DataFrame:
    """Running totals of the run log by run end.

    Runs are added up per day first; the day window has one row per calendar day and the run
    window one day of runs, so no task holds the whole log.
    """
    columns = ["rows_raw", "rows_loaded", "rows_rejected", "rows_duplicate"]
    dated = runs.withColumn("day", F.to_date("ended_at"))
    days = dated.groupBy("day").agg(*[F.sum(c).alias(c) for c in columns])
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    opening = days.select("day", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"open_{c}") for c in columns])
    in_day = Window.partitionBy("day").orderBy("ended_at", "run_id").rowsBetween(Window.unboundedPreceding, 0)
    return dated.join(opening, "day").select(
        "run_id", "ended_at", *[(F.col(f"open_{c}") + F.sum(c).over(in_day)).cast("bigint").alias(f"total_{c}") for c in columns]
    )


def rate_per_minute(df: DataFrame, time: str = "ts", window: str = "5 minutes", slide: str = "1 minute", minutes: int = 5) -> DataFrame:
    """Messages per minute over a sliding window (batch or stream; a stream needs its watermark set)."""
    counted = df.groupBy(F.window(time, window, slide).alias("w")).agg(F.count(F.lit(1)).alias("messages"))
    return counted.select(
        F.col("w.start").alias("window_start"), "messages", (F.col("messages") / F.lit(float(minutes))).alias("per_minute")
    )
