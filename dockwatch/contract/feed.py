"""Contract queries: sources, sinks, typing and projections."""

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from dockwatch import schemas as S
from dockwatch.contract.derived import STATION_ID, before, ntz, readings, sql, table, versions
from dockwatch.contract.registry import register
from dockwatch.functions import text as X
from dockwatch.operators import proximity, relations
from dockwatch.operators.asof import asof_version, attach_reference
from dockwatch.operators.ordering import dedup
from dockwatch.plans import readings as plan
from dockwatch.session import new_folder
from dockwatch.sources import lake, reference

K = "regexp_extract(props, '([0-9]+)', 1)"
# one feed message per event, as text; valid in both engines
MESSAGE = f"""'{{"station_id":' || CAST({STATION_ID} AS STRING) || ',"stationCode":' ||
 CASE WHEN event_id % 97 = 0 THEN 'null' ELSE '"' || lpad(CAST(user_id AS STRING), 5, '0') || '"' END ||
 ',"last_reported":' || CAST(1700000000 + event_id AS STRING) || ',"num_bikes_available":' || {K} || ',"numBikesAvailable":999' ||
 ',"num_bikes_available_types":' || CASE WHEN event_id % 97 = 0 THEN '[{{}},{{}}]' WHEN event_id % 2 = 0
   THEN '[{{"mechanical":' || {K} || '}},{{"ebike":1}}]' ELSE '[{{"ebike":2}},{{"mechanical":' || {K} || '}}]' END ||
 ',"numDocksAvailable":999,"num_docks_available":' || CAST((event_id * 7) % 40 AS STRING) ||
 ',"is_installed":1,"is_renting":' || CASE WHEN event_type = 'view' THEN '0' ELSE '1' END || ',"is_returning":1}}'"""
DOCUMENT = f"""'{{"lastUpdatedOther":' || CAST(1700000000 + event_id AS STRING) || ',"data":{{"stations":[' || {MESSAGE} ||
 ',{{"station_id":' || CAST(user_id + 1000000 AS STRING) || '}}]}}}}'"""


def messages(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", F.expr(MESSAGE).alias("value"))


def documents(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.col("ts").alias("polled_at"), F.expr(DOCUMENT).alias("doc"))


def _stamped(body, stamp):
    return f"""left({body}, length({body}) - 1) || ',"date_collecte":"' || strftime({stamp}, '%Y-%m-%dT%H:%M:%S') || '+00:00"}}'"""


STATIONS_SQL = f"""SELECT CAST({STATION_ID} AS VARCHAR) AS station_id, ts, event_id, {MESSAGE} AS body FROM events
 UNION ALL SELECT CAST(user_id + 1000000 AS VARCHAR), ts, event_id, '{{"station_id":' || CAST(user_id + 1000000 AS VARCHAR) || '}}' FROM events"""


@register("s1_explode", f"""SELECT station_id, ts AS collected_at, {_stamped('body', 'ts')} AS message FROM ({STATIONS_SQL})""")
def s1(spark, sf_dir):
    rows = lake.explode_snapshot(documents(spark, sf_dir))
    return rows.withColumn("collected_at", ntz(F.col("collected_at")))


@register("s2_kafka_frame", f"""SELECT station_id AS key, {_stamped('body', 'ts')} AS value, 'status' AS topic FROM ({STATIONS_SQL})""")
def s2(spark, sf_dir):
    return lake.to_kafka_frame(lake.explode_snapshot(documents(spark, sf_dir)), topic="status")


SERVER = "(TIMESTAMP '1970-01-01' + to_seconds(1700000000 + event_id))"


@register("t10_server_time", f"SELECT station_id, {SERVER} AS collected_at, {_stamped('body', SERVER)} AS message FROM ({STATIONS_SQL})")
def t10(spark, sf_dir):
    rows = lake.explode_snapshot(documents(spark, sf_dir), use_server_time=True)
    return rows.withColumn("collected_at", ntz(F.col("collected_at")))


FLAT_SQL = f"""SELECT CAST({STATION_ID} AS VARCHAR) AS station_id,
 CASE WHEN event_id % 97 = 0 THEN NULL ELSE lpad(CAST(user_id AS VARCHAR), 5, '0') END AS station_code,
 CAST(1700000000 + event_id AS VARCHAR) AS updated_at, {K} AS bikes_total,
 CASE WHEN event_id % 97 = 0 THEN NULL ELSE {K} END AS bikes_mechanical,
 CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 2 = 0 THEN '1' ELSE '2' END AS bikes_electric,
 CAST((event_id * 7) % 40 AS VARCHAR) AS docks_free, '1' AS is_installed,
 CASE WHEN event_type = 'view' THEN '0' ELSE '1' END AS is_renting, '1' AS is_returning"""


@register("s8_flatten", f"{FLAT_SQL} FROM events")
def s8(spark, sf_dir):
    """The messages hold each count under a second name too, with another value: only the first name counts."""
    return lake.flatten_raw_status(messages(spark, sf_dir)).drop("collected_at")


# beside the messages above, which hold both names: every event once more, every third with the second names only, every third with both and
# a look-alike deeper down, the others with the first names only
SECOND_ONLY = f"""replace(replace(replace({MESSAGE}, '"num_bikes_available":' || {K} || ',', ''), '"num_docks_available":' || CAST((event_id * 7) % 40 AS STRING) || ',', ''), '"is_installed":1', '"unused":0,"is_installed":1')"""
BOTH = f"""replace({MESSAGE}, '"is_installed":1', '"unused":{{"num_docks_available":77,"num_bikes_available":78}},"is_installed":1')"""
FIRST_ONLY = f"""replace(replace({MESSAGE}, '"numBikesAvailable":999,', ''), '"numDocksAvailable":999,', '')"""
NAMES = f"CASE event_id % 3 WHEN 0 THEN {SECOND_ONLY} WHEN 1 THEN {BOTH} ELSE {FIRST_ONLY} END"
FIRST_NAMES_COUNT = "* REPLACE (CASE WHEN event_id % 3 <> 0 THEN bikes_total END AS bikes_total, CASE WHEN event_id % 3 <> 0 THEN docks_free END AS docks_free)"


@register("p19_duplicate_fields", f"{FLAT_SQL} FROM events UNION ALL SELECT * EXCLUDE (event_id) FROM (SELECT {FIRST_NAMES_COUNT} FROM ({FLAT_SQL}, event_id FROM events))")
def p19(spark, sf_dir):
    """Whole messages with the counts under both names, their second name only or their first name only: only the first name counts."""
    both = messages(spark, sf_dir).select("value")
    others = table(spark, sf_dir, "events").select(F.expr(NAMES).alias("value"))
    return lake.flatten_raw_status(both.unionByName(others)).drop("collected_at")


def zone_slot():
    """Writing time of a message in the derived raw zone: four files a day."""
    return F.concat(F.lpad((F.floor(F.hour("ts") / 6) * 6).cast("string"), 2, "0"), F.lit("0000"))


def raw_zone(spark, sf_dir):
    """Messages stored as a raw zone, by date and time of writing."""
    path = new_folder(spark, "raw")
    rows = messages(spark, sf_dir).select("value", F.to_date("ts").alias("date"), zone_slot().alias("time"))
    rows.write.partitionBy("date", "time").text(path)
    return path


CUTOFF = "2024-01-20/120000"


@register("s10_until", """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) || '/' || lpad(CAST(CAST(floor(extract(hour FROM ts) / 6) * 6 AS INTEGER) AS VARCHAR), 2, '0') || '0000' AS file_key,
 count(*) AS n_messages FROM events WHERE CAST(CAST(ts AS DATE) AS VARCHAR) || '/' || lpad(CAST(CAST(floor(extract(hour FROM ts) / 6) * 6 AS INTEGER) AS VARCHAR), 2, '0') || '0000' <= '2024-01-20/120000' GROUP BY 1""")
def s10(spark, sf_dir):
    lines = spark.read.schema("value string, date date").text(raw_zone(spark, sf_dir))
    kept = lake.files_until(lake.with_file_key(lines), CUTOFF)
    return kept.groupBy("file_key").agg(F.count("*").alias("n_messages"))


@register("s4_raw_zone", f"{FLAT_SQL} FROM events")
def s4(spark, sf_dir):
    """Two writes of the message stream into the raw zone, read back."""
    root = new_folder(spark, "raw")
    rows = messages(spark, sf_dir)
    for odd, written_at in enumerate((datetime(2024, 2, 1, 8), datetime(2024, 2, 1, 9, 30))):
        lake.write_zone(rows.filter(F.col("event_id") % 2 == odd).select("value"), root, "raw/api", written_at)
    return lake.read_raw_status(spark, f"{root}/raw/api").drop("row_id", "collected_at")


def text_rows(spark, sf_dir):
    """Aggregated-zone rows, all text: readings with the reference text in force."""
    feed, ref = readings(spark, sf_dir), versions(spark, sf_dir)
    joined = attach_reference(feed, ref, asof_version(feed, ref))
    flag = lambda c: F.when(F.col(c), "1").otherwise("0")
    return joined.select(
        F.col("station_id").cast("string").alias("station_id"), "station_code",
        F.concat(F.date_format("collected_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("collected_at"),
        F.unix_timestamp("updated_at").cast("string").alias("updated_at"),
        *[F.col(c).cast("string").alias(c) for c in ("bikes_mechanical", "bikes_electric", "docks_free")],
        *[flag(c).alias(c) for c in ("is_installed", "is_renting", "is_returning")],
        "station_name", "capacity", "coordinates", "town_name", "town_code",
    )


def typed_ntz(df: DataFrame) -> DataFrame:
    return df.withColumn("collected_at", ntz(F.col("collected_at"))).withColumn("updated_at", ntz(F.col("updated_at")))


TYPED_LIVE = r"""SELECT station_id, station_code, regexp_replace(trim(station_name), '\s+', ' ', 'g') AS station_name, latitude, longitude, capacity,
 town_code, town_name, collected_at, updated_at, coalesce(bikes_mechanical, 0) AS bikes_mechanical, coalesce(bikes_electric, 0) AS bikes_electric,
 docks_free, is_installed, is_renting, is_returning FROM before_"""


@register("p3_typing", sql(TYPED_LIVE, "before_"))
def p3(spark, sf_dir):
    return typed_ntz(plan.type_readings(text_rows(spark, sf_dir)))


@register("s7_aggregated", sql(TYPED_LIVE, "before_"))
def s7(spark, sf_dir):
    root = new_folder(spark, "zone")
    lake.write_zone(lake.to_aggregated_fields(text_rows(spark, sf_dir)), root, "aggregated", datetime(2024, 2, 1))
    return typed_ntz(plan.type_readings(lake.read_aggregated(spark, f"{root}/aggregated")))


VERSION_TEXT = """SELECT version_ts, trim(station_code) AS station_code, station_name, capacity, coordinates, town_name, town_code FROM versions"""


def write_versions(spark, sf_dir, path):
    """Versions stored as reference files, one folder per download."""
    v = versions(spark, sf_dir)
    fields = [F.col(c).alias(f) for f, c in S.REFERENCE_CSV.items()]
    v.select(*fields, F.to_date("version_ts").alias("date"), F.date_format("version_ts", "HHmmss").alias("time")).write.partitionBy(
        "date", "time").option("sep", ";").option("header", "true").option("ignoreTrailingWhiteSpace", "false").option(
        "ignoreLeadingWhiteSpace", "false").csv(path)
    return path


@register("s6_reference_files", sql(VERSION_TEXT, "versions"))
def s6(spark, sf_dir):
    path = write_versions(spark, sf_dir, new_folder(spark, "reference"))
    rows = reference.read_reference_versions(spark, path).drop("version_file", "line")
    return rows.withColumn("version_ts", ntz(F.col("version_ts")))


@register("s11_clean_zone", sql("SELECT CAST(collected_at AS DATE) AS date, count(*) AS n_rows, sum(bikes_total)::BIGINT AS bikes FROM before_ GROUP BY 1", "before_"))
def s11(spark, sf_dir):
    path = new_folder(spark, "clean")
    lake.write_clean(before(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("date").agg(F.count("*").alias("n_rows"), F.sum("bikes_total").alias("bikes"))


@register("s12_staging", sql("SELECT row_id, station_id, collected_at, capacity, station_name FROM before_", "before_"))
def s12(spark, sf_dir):
    path = new_folder(spark, "staging")
    lake.write_staging(before(spark, sf_dir).select("row_id", "station_id", "collected_at", "capacity", "station_name"), path)
    return spark.read.parquet(path)


@register("s13_zone_counts", """SELECT 'raw' AS zone, count(*) AS records FROM events UNION ALL
 SELECT 'nations', count(*) FROM nation""")
def s13(spark, sf_dir):
    nations = new_folder(spark, "nations")
    table(spark, sf_dir, "nation").select("n_name").write.text(nations)
    return lake.zone_counts(spark, {"raw": raw_zone(spark, sf_dir), "nations": nations})


@register("s13_reference_size", sql("SELECT count(*) AS stations, version_ts FROM versions WHERE version_ts = (SELECT max(version_ts) FROM versions) GROUP BY version_ts", "versions"))
def s13b(spark, sf_dir):
    return reference.reference_size(versions(spark, sf_dir))


# text with the faults a feed can have; the expressions are valid in both engines
MESSY = {
    "int_text": """CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN ' ' || CAST(user_id AS STRING) || ' ' WHEN 2 THEN '-' || CAST(user_id AS STRING)
 WHEN 3 THEN CAST(user_id AS STRING) || '.5' WHEN 4 THEN '1e3' WHEN 5 THEN NULL WHEN 6 THEN 'NaN' ELSE CAST(user_id AS STRING) END""",
    "flag_text": "CASE event_id % 5 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN NULL WHEN 3 THEN 'x' ELSE ' 1 ' END",
    "yes_no_text": "CASE event_id % 5 WHEN 0 THEN 'OUI' WHEN 1 THEN 'NON' WHEN 2 THEN 'oui' WHEN 3 THEN NULL ELSE '?' END",
    "epoch_text": "CASE event_id % 8 WHEN 5 THEN NULL WHEN 6 THEN 'abc' ELSE CAST(1700000000 + event_id * 61 AS STRING) END",
    "iso_text": """CASE event_id % 8 WHEN 5 THEN NULL WHEN 6 THEN 'not a time' ELSE '2024-01-0' || CAST(1 + event_id % 9 AS STRING) || 'T0' ||
 CAST(event_id % 10 AS STRING) || ':15:30+02:00' END""",
    "coord_text": """CASE event_id % 6 WHEN 0 THEN '48.' || CAST(80000 + user_id AS STRING) || ', 2.' || CAST(30000 + event_id % 100 AS STRING)
 WHEN 1 THEN '48.8' WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN 'x,2.3' ELSE '-48.5 ,-2.25' END""",
    "code_text": """CASE event_id % 6 WHEN 0 THEN CAST(1000 + event_id % 9000 AS STRING) WHEN 1 THEN '75056' WHEN 2 THEN '750561' WHEN 3 THEN ''
 WHEN 4 THEN NULL ELSE ' 92012 ' END""",
    "name_text": """CASE event_id % 6 WHEN 0 THEN 'Stop  ' || CAST(user_id AS STRING) WHEN 1 THEN ' Stop ' WHEN 2 THEN 'Stop' || chr(9) || 'B'
 WHEN 3 THEN 'Stop' || chr(160) || 'C' WHEN 4 THEN NULL ELSE 'Stop ' || CAST(user_id AS STRING) END""",
    "types_text": f"""CASE event_id % 7 WHEN 0 THEN '[{{"mechanical": ' || {K} || '}}, {{"ebike": 1}}]' WHEN 1 THEN '[{{"ebike": 4}}, {{"mechanical": ' || {K} || '}}]'
 WHEN 2 THEN '[{{}}, {{}}]' WHEN 3 THEN '[{{"mechanical": 3}}]' WHEN 4 THEN '[{{"cargo": 9}}, {{"ebike": 5}}]' WHEN 5 THEN NULL ELSE '[{{"ebike": 6}}, {{"ebike": 7}}]' END""",
}


def messy(spark, sf_dir, column):
    return table(spark, sf_dir, "events").select("event_id", F.expr(MESSY[column]).alias("t"))


def messy_sql(select, column):
    return f"SELECT event_id, {select} FROM (SELECT event_id, {MESSY[column]} AS t FROM events)"


def typed(name, column, select, build):
    """Register one typing rule over the whole events table."""
    @register(name, messy_sql(select, column))
    def run(spark, sf_dir):
        return messy(spark, sf_dir, column).select("event_id", *build())
    return run


SOFT_DOUBLE = r"CASE WHEN regexp_full_match(trim({0}), '-?\d+(\.\d+)?') THEN TRY_CAST(trim({0}) AS DOUBLE) END"
typed("p1_soft_int", "int_text", r"CASE WHEN regexp_full_match(trim(t), '-?\d+') THEN TRY_CAST(trim(t) AS BIGINT) END AS v",
      lambda: [X.soft_int("t").alias("v")])
typed("p2_soft_double", "int_text", SOFT_DOUBLE.format("t") + " AS v", lambda: [X.soft_double("t").alias("v")])
typed("p4_epoch", "epoch_text", r"CASE WHEN regexp_full_match(t, '\d+') THEN TIMESTAMP '1970-01-01' + to_seconds(TRY_CAST(t AS BIGINT)) END AS v",
      lambda: [ntz(X.epoch_ts("t")).alias("v")])
typed("p5_iso", "iso_text", "TRY_CAST(replace(t, '+02:00', '') AS TIMESTAMP) - INTERVAL '2' HOUR AS v", lambda: [ntz(X.iso_ts("t")).alias("v")])
typed("p6_flag", "flag_text", "CASE WHEN trim(t) IN ('0', '1') THEN trim(t) = '1' END AS v", lambda: [X.flag01("t").alias("v")])
typed("p7_yes_no", "yes_no_text", "CASE upper(t) WHEN 'OUI' THEN true WHEN 'NON' THEN false END AS v", lambda: [X.flag_yes_no("t").alias("v")])
typed("p8_coords", "coord_text", SOFT_DOUBLE.format("split_part(t, ',', 1)") + " AS lat, " + SOFT_DOUBLE.format("split_part(t, ',', 2)") + " AS lon",
      lambda: [X.split_coords("t")[0].alias("lat"), X.split_coords("t")[1].alias("lon")])
typed("p9_names", "name_text", r"regexp_replace(trim(t), '\s+', ' ', 'g') AS v, t <> regexp_replace(trim(t), '\s+', ' ', 'g') AS changed, (t <> trim(t) OR regexp_matches(t, '\s{2,}')) AS extra",
      lambda: [X.squash_ws("t").alias("v"), X.name_changed("t").alias("changed"), X.has_extra_ws("t").alias("extra")])
typed("p10_pad", "code_text", "CASE WHEN trim(t) <> '' THEN lpad(trim(t), 5, '0') END AS v", lambda: [X.pad_code("t").alias("v")])
typed("p11_dept", "code_text", "left(CASE WHEN trim(t) <> '' THEN lpad(trim(t), 5, '0') END, 2) AS v", lambda: [X.dept_of(X.pad_code("t")).alias("v")])


@register("p9_squash_documents", r"""SELECT doc_id, md5(regexp_replace(trim(text), '\s+', ' ', 'g')) AS digest,
 CAST(length(regexp_replace(trim(text), '\s+', ' ', 'g')) AS BIGINT) AS n, text <> regexp_replace(trim(text), '\s+', ' ', 'g') AS changed FROM documents""")
def p9d(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(X.squash_ws("text").cast("binary")).alias("digest"), F.length(X.squash_ws("text")).cast("bigint").alias("n"),
                    X.name_changed("text").alias("changed"))


@register("p12_types", f"""SELECT event_id, CASE WHEN event_id % 7 IN (0, 1) THEN CAST({K} AS BIGINT) WHEN event_id % 7 = 3 THEN 3 END AS mechanical,
 CAST(CASE event_id % 7 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 4 THEN 5 WHEN 6 THEN 7 END AS BIGINT) AS ebike FROM events""")
def p12(spark, sf_dir):
    parsed = messy(spark, sf_dir, "types_text").withColumn("m", F.from_json("t", "array<map<string,string>>"))
    merged = X.merge_type_maps("m")
    return parsed.select("event_id", X.soft_int(X.type_count(merged, S.MECHANICAL)).alias("mechanical"),
                         X.soft_int(X.type_count(merged, S.ELECTRIC)).alias("ebike"))


@register("p13_fill", sql("SELECT row_id, coalesce(bikes_mechanical, 0) AS bikes_mechanical, coalesce(bikes_electric, 0) AS bikes_electric FROM readings", "readings"))
def p13(spark, sf_dir):
    return plan.fill_counts(readings(spark, sf_dir)).select("row_id", "bikes_mechanical", "bikes_electric")


REASON = """CASE WHEN NOT coalesce(capacity > 0 AND docks_free >= 0 AND town_code IS NOT NULL AND station_name IS NOT NULL AND latitude IS NOT NULL
 AND longitude IS NOT NULL AND updated_at IS NOT NULL AND collected_at IS NOT NULL AND station_id IS NOT NULL AND is_installed IS NOT NULL, false) THEN 'invalid'
 WHEN station_code IS NULL OR town_name IS NULL OR is_renting IS NULL OR is_returning IS NULL THEN 'not loadable'"""
REJECTED = """SELECT station_id, collected_at, docks_free, reason FROM (SELECT *, {0} END AS reason FROM before_) WHERE reason IS NOT NULL"""


@register("p14_rejected", sql(REJECTED.format(REASON), "before_"))
def p14(spark, sf_dir):
    _, refused = plan.split_valid(plan.type_readings(text_rows(spark, sf_dir)))
    return typed_ntz(refused).select("station_id", "collected_at", "docks_free", "reason")


@register("t11_silent_rejected", sql(REJECTED.format(REASON + " WHEN updated_at < collected_at - INTERVAL '24' HOUR THEN 'silent'"), "before_"))
def t11(spark, sf_dir):
    _, refused = plan.split_valid(plan.type_readings(text_rows(spark, sf_dir)), drop_silent=True)
    return typed_ntz(refused).select("station_id", "collected_at", "docks_free", "reason")


@register("p15_run_counts", sql(f"""SELECT count(*) AS rows_raw, count(reason) AS rows_rejected,
 count(DISTINCT CASE WHEN reason IS NULL THEN row(station_id, collected_at) END) AS rows_loaded,
 count(*) - count(reason) - count(DISTINCT CASE WHEN reason IS NULL THEN row(station_id, collected_at) END) AS rows_duplicate
 FROM (SELECT *, {REASON} END AS reason FROM before_)""", "before_"))
def p15(spark, sf_dir):
    all_rows = plan.type_readings(text_rows(spark, sf_dir))
    usable, _ = plan.split_valid(all_rows)
    return plan.run_counts(all_rows, dedup(usable, order=("updated_at", "docks_free")))


@register("p16_unpivot", sql("""SELECT row_id, 'mechanical' AS type_code, bikes_mechanical AS bikes FROM readings
 UNION ALL SELECT row_id, 'ebike', bikes_electric FROM readings""", "readings"))
def p16(spark, sf_dir):
    return relations.unpivot_types(readings(spark, sf_dir), ["row_id"])


@register("p17_pivot", sql("""SELECT row_id AS reading_id, coalesce(bikes_mechanical, 0) AS bikes_mechanical, coalesce(bikes_electric, 0) AS bikes_electric,
 bikes_mechanical + bikes_electric AS bikes_total FROM readings""", "readings"))
def p17(spark, sf_dir):
    from dockwatch.operators.load import insert_children, seed_types

    types = seed_types(spark)
    children = insert_children(readings(spark, sf_dir).withColumnRenamed("row_id", "reading_id"), types)
    return relations.pivot_types(children, types, keep_null=False)


@register("p18_partition_date", sql("SELECT row_id, CAST(collected_at AS DATE) AS date FROM readings", "readings"))
def p18(spark, sf_dir):
    return readings(spark, sf_dir).select("row_id", F.to_date("collected_at").alias("date"))


@register("p20_status", """SELECT l_linenumber, n_before, n_after, CASE WHEN n_after = 0 THEN 'OK' WHEN n_after < n_before THEN 'reduced' ELSE 'accepted' END AS status
 FROM (SELECT l_linenumber, count(*) FILTER (WHERE l_returnflag = 'A') AS n_before, count(*) FILTER (WHERE l_returnflag = 'R') AS n_after FROM lineitem GROUP BY l_linenumber)""")
def p20(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(
        F.count_if(F.col("l_returnflag") == "A").alias("n_before"), F.count_if(F.col("l_returnflag") == "R").alias("n_after"))
    return counts.withColumn("status", X.compare_status("n_before", "n_after"))


@register("p21_map_points", sql("""SELECT station_code, latitude, longitude, (bikes_mechanical + bikes_electric) * 8 + 10 AS size,
 CASE WHEN bikes_mechanical + bikes_electric > 0 THEN '#2ca02c' ELSE '#d62728' END AS colour FROM before_""", "before_"))
def p21(spark, sf_dir):
    return proximity.map_points(before(spark, sf_dir))


@register("p22_percentage", """SELECT l_shipdate, round(100.0::DOUBLE * n_returned / nullif(n_open, 0), 2) AS pct FROM
 (SELECT l_shipdate, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned, count(*) FILTER (WHERE l_linestatus = 'O') AS n_open FROM lineitem GROUP BY l_shipdate)""")
def p22(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_shipdate").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"), F.count_if(F.col("l_linestatus") == "O").alias("n_open"))
    return counts.select("l_shipdate", X.pct("n_returned", "n_open").alias("pct"))
