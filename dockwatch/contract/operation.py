"""Contract queries: live path, stream twins and monitoring."""

from datetime import datetime

from pyspark.sql import functions as F

from dockwatch.contract.derived import STATION_ID, ntz, readings, sql, table, versions
from dockwatch.contract.feed import MESSAGE, raw_zone, write_versions
from dockwatch.contract.registry import register
from dockwatch.contract.analytics import KPI
from dockwatch.operators import load
from dockwatch.operators.relations import latest_state, stack
from dockwatch.plans import availability as V, monitoring as M
from dockwatch.session import materialise, new_folder
from dockwatch.sources import lake
from dockwatch.streaming import live

# --- run log derived from the events: one run per day -----------------------------------------

RUNS_SQL = """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, min(ts) AS started_at, max(ts) AS ended_at, count(DISTINCT extract(hour FROM ts)) AS files,
 count(*) AS rows_raw, count(*) FILTER (WHERE event_type = 'error') AS rows_rejected, count(*) FILTER (WHERE event_type = 'view' AND value < 5) AS rows_duplicate,
 count(*) - count(*) FILTER (WHERE event_type = 'error') - count(*) FILTER (WHERE event_type = 'view' AND value < 5) AS rows_loaded
 FROM events GROUP BY CAST(ts AS DATE)"""
RUNS = [("runs", RUNS_SQL)]


def runs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rejected = F.count_if(F.col("event_type") == "error")
    duplicate = F.count_if((F.col("event_type") == "view") & (F.col("value") < 5))
    return e.groupBy(F.to_date("ts").cast("string").alias("run_id")).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("ended_at"), F.countDistinct(F.hour("ts")).alias("files"),
        F.count("*").alias("rows_raw"), rejected.alias("rows_rejected"), duplicate.alias("rows_duplicate"),
        (F.count("*") - rejected - duplicate).alias("rows_loaded"))


@register("a9_run_totals", sql("""SELECT count(*) AS runs, CAST(sum(rows_raw) AS BIGINT) AS rows_raw, CAST(sum(rows_rejected) AS BIGINT) AS rows_rejected,
 CAST(sum(rows_duplicate) AS BIGINT) AS rows_duplicate, CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded, CAST(floor(epoch(max(ended_at))) AS BIGINT) AS last_run FROM runs""", extra=RUNS))
def a9(spark, sf_dir):
    return M.run_totals(runs(spark, sf_dir))


@register("m1_clean_ratio", sql("""SELECT pct AS clean_pct, CASE WHEN pct < 80 THEN 'red' WHEN pct < 95 THEN 'orange' ELSE 'green' END AS band FROM
 (SELECT round(100.0::DOUBLE * sum(rows_loaded) / sum(rows_raw), 2) AS pct FROM runs)""", extra=RUNS))
def m1(spark, sf_dir):
    return M.clean_ratio(runs(spark, sf_dir))


@register("m2_run_age", sql("""SELECT age AS age_s, CASE WHEN age < 300 THEN 'green' WHEN age < 900 THEN 'orange' ELSE 'red' END AS band FROM
 (SELECT CAST(epoch(TIMESTAMP '2024-01-31 00:10:00') - floor(epoch(max(ended_at))) AS BIGINT) AS age FROM runs)""", extra=RUNS))
def m2(spark, sf_dir):
    return M.run_age(runs(spark, sf_dir), ntz(F.lit(datetime(2024, 1, 31, 0, 10))))


@register("m3_pending", sql("SELECT (SELECT count(*) FROM events) - (SELECT CAST(sum(rows_raw) AS BIGINT) FROM runs WHERE run_id < '2024-01-29') AS pending", extra=RUNS))
def m3(spark, sf_dir):
    zones = lake.zone_counts(spark, {"aggregated": raw_zone(spark, sf_dir)})
    return M.pending(zones, runs(spark, sf_dir).filter(F.col("run_id") < "2024-01-29"))


@register("m4_source_errors", """SELECT 'user ' || CAST(user_id AS VARCHAR) AS source, count(*) FILTER (WHERE event_type = 'error') AS errors,
 count(*) FILTER (WHERE event_type = 'error') < 1 AS healthy FROM events GROUP BY user_id""")
def m4(spark, sf_dir):
    errors = table(spark, sf_dir, "events").select(
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("source"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("errors"))
    return M.source_errors(errors)


@register("t6_cumulative", sql("""SELECT run_id, ended_at, CAST(sum(rows_raw) OVER w AS BIGINT) AS total_rows_raw, CAST(sum(rows_loaded) OVER w AS BIGINT) AS total_rows_loaded,
 CAST(sum(rows_rejected) OVER w AS BIGINT) AS total_rows_rejected, CAST(sum(rows_duplicate) OVER w AS BIGINT) AS total_rows_duplicate
 FROM runs WINDOW w AS (ORDER BY ended_at, run_id)""", extra=RUNS))
def t6(spark, sf_dir):
    return M.cumulative_counts(runs(spark, sf_dir))


@register("t5_rate", """SELECT window_start, count(*) AS messages, count(*) / 5.0::DOUBLE AS per_minute FROM
 (SELECT time_bucket(INTERVAL '1' MINUTE, ts) - to_minutes(CAST(i AS BIGINT)) AS window_start FROM events, range(5) t(i)) GROUP BY 1""")
def t5(spark, sf_dir):
    rates = M.rate_per_minute(table(spark, sf_dir, "events"))
    return rates.withColumn("window_start", ntz(F.col("window_start")))


# codes that change during the month; three batches of ten days
CHANGED = "CASE WHEN collected_at < TIMESTAMP '2024-01-08 00:00:00' THEN 'old' || station_code WHEN row_id % 5 = 2 THEN NULL ELSE station_code END"


@register("t8_carried_codes", sql(f"""SELECT b.row_id, b.station_id, coalesce(b.station_code, (SELECT arg_max(p.station_code, (p.collected_at, p.station_code)) FROM b p
 WHERE p.station_id = b.station_id AND p.part <= b.part AND p.station_code IS NOT NULL)) AS station_code FROM b""", "readings", extra=[
    ("b", f"SELECT row_id, station_id, collected_at, {CHANGED} AS station_code, least(2, (extract(day FROM collected_at) - 1) // 10) AS part FROM readings")]))
def t8(spark, sf_dir):
    """Lost codes filled batch by batch with the last code known at that time."""
    store = new_folder(spark, "codes")
    rows = readings(spark, sf_dir).select("row_id", "station_id", "collected_at", F.expr(CHANGED).alias("station_code"))
    part = F.least(F.lit(2), F.floor((F.dayofmonth("collected_at") - 1) / 10))
    filled = [materialise(live.carry_code(rows.filter(part == n), store), "carried") for n in range(3)]
    return stack(*filled).select("row_id", "station_id", "station_code")


@register("l5_run_log", sql("SELECT * FROM runs", extra=RUNS))
def l5(spark, sf_dir):
    """The run log of all runs, recorded in one write after a first line of one of them, and read back."""
    path = new_folder(spark, "runs")
    lines = materialise(runs(spark, sf_dir), "runs")
    load.record_run(spark, path, lines.filter("run_id = '2024-01-27'").withColumn("rows_raw", F.lit(0)))
    load.record_run(spark, path, lines)
    log = load.read_runs(spark, path)
    return log.withColumns({c: ntz(F.col(c)) for c in ("started_at", "ended_at")})


# --- streams run to the end of the supplied data ----------------------------------------------

def finish(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


@register("t3_dedup_stream", sql("SELECT DISTINCT station_id, collected_at FROM readings", "readings"))
def t3(spark, sf_dir):
    """Repeated messages dropped by a stream over the events table."""
    path = new_folder(spark, "dedup")
    schema = table(spark, sf_dir, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    timed = source.select(F.expr(STATION_ID).alias("station_id"), F.date_trunc("hour", "ts").alias("collected_at"))
    out = live.dedup_stream(timed, "10 minutes").writeStream.format("parquet").option("path", f"{path}/rows").option(
        "checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    finish(out.start())
    return spark.read.parquet(f"{path}/rows").withColumn("collected_at", ntz(F.col("collected_at")))


LIVE_MESSAGE = f"left({MESSAGE}, length({MESSAGE}) - 1) || ',\"date_collecte\":\"' || date_format(date_trunc('hour', ts), \"yyyy-MM-dd'T'HH:mm:ss\") || '+00:00\"}}'"


def live_lake(spark, sf_dir):
    """Messages and reference files on disk, streamed into the raw and aggregated zones."""
    root = new_folder(spark, "lake")
    write_versions(spark, sf_dir, f"{root}/raw/source2")
    table(spark, sf_dir, "events").select(F.expr(LIVE_MESSAGE).alias("value")).write.text(f"{root}/topic")
    source = live.read_status_stream(spark, f"{root}/topic", "text")
    finish(live.run_two_zone_stream(source, root, f"{root}/raw/source2", f"{root}/checkpoint/zones", once=True))
    return root


NEWEST = """(SELECT station_code, trim(station_code) AS c, station_name, capacity, coordinates, town_name, town_code FROM versions
 WHERE version_ts = (SELECT max(version_ts) FROM versions) AND station_code IS NOT NULL)"""
ENRICHED = f"""SELECT CAST(r.station_id AS VARCHAR) AS station_id, r.station_code, strftime(r.collected_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS collected_at,
 CAST(1700000000 + r.row_id AS VARCHAR) AS updated_at, n.station_name, n.capacity, n.coordinates, n.town_name, n.town_code
 FROM readings r LEFT JOIN {NEWEST} n ON n.station_code = r.station_code"""


@register("t1_two_zones", sql(ENRICHED, "readings", "versions"))
def t1(spark, sf_dir):
    root = live_lake(spark, sf_dir)
    return lake.read_aggregated(spark, f"{root}/aggregated").select(
        "station_id", "station_code", "collected_at", "updated_at", "station_name", "capacity", "coordinates", "town_name", "town_code")


LOADED = f"""SELECT DISTINCT r.station_id, r.collected_at, n.station_code, regexp_replace(trim(n.station_name), '\\s+', ' ', 'g') AS station_name,
 CAST(n.capacity AS BIGINT) AS capacity, n.town_code, n.town_name FROM readings r JOIN {NEWEST} n ON n.station_code = r.station_code WHERE CAST(n.capacity AS BIGINT) > 0"""


@register("m5_stream_report", sql(f"""SELECT count(*) AS messages, count(*) FILTER (WHERE n.station_code IS NULL) AS unmatched, 0::BIGINT AS lag
 FROM readings r LEFT JOIN {NEWEST} n ON n.station_code = r.station_code""", "readings", "versions"))
def m5(spark, sf_dir):
    """What the message stream has recorded of its batches."""
    report = live.stream_report(spark, live_lake(spark, sf_dir))
    return report.agg(F.sum("messages").alias("messages"), F.sum("unmatched").alias("unmatched"), F.coalesce(F.max("lag"), F.lit(0)).cast("bigint").alias("lag"))


@register("t4_live_load", sql(LOADED, "readings", "versions"))
def t4(spark, sf_dir):
    """The whole live path: stream, zones, incremental cleaning, load, flat view."""
    root = live_lake(spark, sf_dir)
    finish(live.run_incremental(spark, root, f"{root}/checkpoint/load"))
    view = load.flat_view(lake.read_target(spark, f"{root}/target"))
    return view.select("station_id", ntz(F.col("collected_at")).alias("collected_at"), "station_code", "station_name", "capacity", "town_code", "town_name")


def stored_target(spark, sf_dir):
    """The repaired tables stored by day and read back."""
    from dockwatch.contract.quality import target

    root = new_folder(spark, "target")
    lake.write_target(target(spark, sf_dir), root)
    return lake.read_target(spark, root)


LAST_POLL = [("last_poll", "SELECT * FROM after_ WHERE collected_at = (SELECT max(collected_at) FROM after_)")]


@register("j7_stored_state", sql("SELECT station_id, station_code, collected_at, bikes_total, docks_free, CAST(collected_at AS DATE) AS date FROM last_poll", "after_", extra=LAST_POLL))
def j7s(spark, sf_dir):
    return latest_state(stored_target(spark, sf_dir)).select("station_id", "station_code", "collected_at", "bikes_total", "docks_free", "date")


@register("a5_stored_kpis", sql(f"{KPI} FROM last_poll", "after_", extra=LAST_POLL))
def a5s(spark, sf_dir):
    return V.kpis(latest_state(stored_target(spark, sf_dir)))


@register("a7_stored_top_towns", sql("""SELECT town_name, CAST(sum(bikes_mechanical) AS BIGINT) AS mechanical, CAST(sum(bikes_electric) AS BIGINT) AS electric,
 CAST(sum(bikes_total) AS BIGINT) AS total FROM last_poll GROUP BY 1 ORDER BY total DESC, town_name LIMIT 15""", "after_", extra=LAST_POLL))
def a7s(spark, sf_dir):
    return V.top_towns(latest_state(stored_target(spark, sf_dir)))


@register("a8_stored_fill_rate", sql("""SELECT town_name, count(*) AS stations, round_even(avg(bikes_total::DOUBLE / capacity) * 100, 1) AS fill_pct FROM last_poll GROUP BY 1""", "after_", extra=LAST_POLL))
def a8s(spark, sf_dir):
    return V.fill_rate(latest_state(stored_target(spark, sf_dir)), min_stations=1)


@register("a6_stored_series", sql("""SELECT collected_at, CAST(sum(bikes_mechanical) AS BIGINT) AS mechanical, CAST(sum(bikes_electric) AS BIGINT) AS electric FROM after_
 WHERE collected_at > TIMESTAMP '2024-01-30 22:00:00' - INTERVAL '24' HOUR GROUP BY 1""", "after_"))
def a6s(spark, sf_dir):
    view = load.flat_view(stored_target(spark, sf_dir))
    return V.series_24h(view, ntz(F.lit(datetime(2024, 1, 30, 22))))


@register("s14_read_target", sql("""SELECT 'town' AS table_name, count(*) AS n_rows FROM town_dim UNION ALL SELECT 'station', count(*) FROM station_dim
 UNION ALL SELECT 'bike_type', 2 UNION ALL SELECT 'reading', count(*) FROM reading_ UNION ALL SELECT 'reading_bikes', 2 * count(*) FROM reading_""", "reading_", "station_dim", "town_dim"))
def s14(spark, sf_dir):
    from dockwatch.contract.quality import target
    from dockwatch.operators.aggregates import table_counts

    root = new_folder(spark, "target")
    lake.write_target(target(spark, sf_dir), root)
    return table_counts(lake.read_target(spark, root))
