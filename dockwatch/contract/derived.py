"""Station readings and reference versions derived from the supplied tables.

``events`` plays the status feed: user -> station, hour -> collection, ``props.k`` -> bikes. The
supplied rows are clean, so anomalies are planted by rules on ids, in the same way on both sides:
``*_SQL`` holds the text for the checking engine.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockwatch.operators.asof import asof_version, attach_reference
from dockwatch.session import materialise
from dockwatch.sources.reference import type_reference

# versions need this many named rows to be valid (the smallest table has 15 stations)
MIN_NAMED = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ntz(column):
    return column.cast("timestamp_ntz")


def code_text(column):
    return F.lpad(column.cast("string"), 5, "0")


# station of a user, valid in both engines: some ids lie beyond 32 bits, some at the end of the BIGINT range
STATION_ID = "(CASE user_id % 11 WHEN 5 THEN user_id + 5000000000 WHEN 7 THEN 9223372036854775807 - user_id ELSE user_id END)"


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(table(spark, sf_dir, "events"))


def readings_of(e: DataFrame) -> DataFrame:
    """Typed feed readings with planted clock errors, lost codes and lost splits."""
    hour = ntz(F.date_trunc("hour", "ts"))
    bikes = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    electric = F.floor(bikes / F.lit(3.0)).cast("bigint")
    lost = F.col("event_id") % 97 == 0
    late_hour = (F.dayofmonth("ts") * 24 + F.hour("ts")) % 50 == 7
    updated = (
        F.when(late_hour, hour + F.expr("INTERVAL 58 MINUTES"))
        .when(F.col("user_id") % 53 == 0, hour - F.expr("INTERVAL 30 HOURS"))
        .otherwise(hour - F.expr("INTERVAL 2 MINUTES"))
    )
    return e.select(
        F.col("event_id").alias("row_id"), F.expr(STATION_ID).alias("station_id"),
        F.when(~lost, code_text(F.col("user_id"))).alias("station_code"),
        hour.alias("collected_at"), updated.alias("updated_at"), bikes.alias("bikes_total"),
        F.when(~lost, bikes - electric).alias("bikes_mechanical"), F.when(~lost, electric).alias("bikes_electric"),
        ((F.col("event_id") * 7) % 40).cast("bigint").alias("docks_free"),
        (F.col("event_type") != "error").alias("is_installed"),
        (F.col("event_type") != "view").alias("is_renting"), (F.col("event_type") != "click").alias("is_returning"),
    )


READINGS_SQL = f"""SELECT event_id AS row_id, {STATION_ID} AS station_id,
 CASE WHEN event_id % 97 = 0 THEN NULL ELSE lpad(CAST(user_id AS VARCHAR), 5, '0') END AS station_code,
 date_trunc('hour', ts) AS collected_at,
 CASE WHEN (extract(day FROM ts) * 24 + extract(hour FROM ts)) % 50 = 7 THEN date_trunc('hour', ts) + INTERVAL '58' MINUTE
      WHEN user_id % 53 = 0 THEN date_trunc('hour', ts) - INTERVAL '30' HOUR
      ELSE date_trunc('hour', ts) - INTERVAL '2' MINUTE END AS updated_at,
 k AS bikes_total,
 CASE WHEN event_id % 97 = 0 THEN NULL ELSE k - CAST(floor(k / 3.0) AS BIGINT) END AS bikes_mechanical,
 CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(floor(k / 3.0) AS BIGINT) END AS bikes_electric,
 CAST((event_id * 7) % 40 AS BIGINT) AS docks_free, event_type <> 'error' AS is_installed,
 event_type <> 'view' AS is_renting, event_type <> 'click' AS is_returning
 FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)"""


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions_of(table(spark, sf_dir, "events"))


def versions_of(e: DataFrame) -> DataFrame:
    """One reference version per day at 06:00, all text; some days are almost blank."""
    days = e.select(F.to_date("ts").alias("day")).distinct()
    span = F.sequence(days.agg(F.min("day")).scalar(), days.agg(F.max("day")).scalar())
    u = F.col("user_id")
    grid = e.select("user_id").distinct().select("user_id", F.explode(span).alias("day")).join(days, "day", "left_semi")
    shown = ~((F.dayofmonth("day") % 10 == 3) & (u != 1))
    text = u.cast("string")
    return grid.select(
        (ntz(F.col("day")) + F.expr("INTERVAL 6 HOURS")).alias("version_ts"),
        F.when(shown, code_text(u)).alias("station_code"),
        F.when(shown, F.when(u % 37 == 0, F.concat(F.lit("Stop  "), text, F.lit(" "))).otherwise(F.concat(F.lit("Stop "), text))).alias("station_name"),
        F.when(shown, F.when(u % 41 == 0, "0").otherwise((60 + u % 60).cast("string"))).alias("capacity"),
        F.when(shown, F.concat(F.lit("48."), (80000 + (u % 100) * 100).cast("string"), F.lit(", 2."), (20000 + (u % 70) * 300).cast("string"))).alias("coordinates"),
        F.when(shown, F.concat(F.lit("Town "), (u % 20).cast("string"))).alias("town_name"),
        F.when(shown, (75000 + u % 20).cast("string")).alias("town_code"),
    )


VERSIONS_SQL = """SELECT v.version_ts,
 CASE WHEN hidden THEN NULL ELSE lpad(CAST(user_id AS VARCHAR), 5, '0') END AS station_code,
 CASE WHEN hidden THEN NULL WHEN user_id % 37 = 0 THEN 'Stop  ' || CAST(user_id AS VARCHAR) || ' ' ELSE 'Stop ' || CAST(user_id AS VARCHAR) END AS station_name,
 CASE WHEN hidden THEN NULL WHEN user_id % 41 = 0 THEN '0' ELSE CAST(60 + user_id % 60 AS VARCHAR) END AS capacity,
 CASE WHEN hidden THEN NULL ELSE '48.' || CAST(80000 + (user_id % 100) * 100 AS VARCHAR) || ', 2.' || CAST(20000 + (user_id % 70) * 300 AS VARCHAR) END AS coordinates,
 CASE WHEN hidden THEN NULL ELSE 'Town ' || CAST(user_id % 20 AS VARCHAR) END AS town_name,
 CASE WHEN hidden THEN NULL ELSE CAST(75000 + user_id % 20 AS VARCHAR) END AS town_code
 FROM (SELECT d.version_ts, u.user_id, d.blank AND u.user_id <> 1 AS hidden
       FROM (SELECT DISTINCT date_trunc('day', ts) + INTERVAL '6' HOUR AS version_ts, extract(day FROM ts) % 10 = 3 AS blank FROM events) d
       CROSS JOIN (SELECT DISTINCT user_id FROM events) u) v"""

TYPED_SQL = """CAST(v.capacity AS BIGINT) AS capacity,
 CAST(trim(split_part(v.coordinates, ',', 1)) AS DOUBLE) AS latitude, CAST(trim(split_part(v.coordinates, ',', 2)) AS DOUBLE) AS longitude,
 v.town_code, v.town_name"""


def before(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    """Readings with the reference version in force at their collection, blank or not."""
    out = before_of(readings(spark, sf_dir), versions(spark, sf_dir))
    return materialise(out, "before") if stored else out


def before_of(feed: DataFrame, reference: DataFrame) -> DataFrame:
    return attach_reference(feed, type_reference(reference), asof_version(feed, reference))


# readings with faults that the repair rules delete: stations without any split, codes the reference does not know
FAULTY = {
    "bikes_mechanical": "CASE WHEN station_id % 61 = 7 THEN NULL ELSE bikes_mechanical END",
    "bikes_electric": "CASE WHEN station_id % 61 = 7 THEN NULL ELSE bikes_electric END",
    "station_code": "CASE WHEN station_id % 67 = 3 THEN 'Q' || station_code ELSE station_code END",
}
# audited rows with the faults that the readings above never have; every check finds some
DIRTY = {
    "docks_free": "CASE WHEN row_id % 101 = 1 THEN -1 - docks_free ELSE docks_free END",
    "latitude": "CASE WHEN row_id % 103 = 2 THEN CAST(10.5 AS DOUBLE) ELSE latitude END",
    "town_code": "CASE WHEN row_id % 107 = 3 THEN '99001' WHEN row_id % 107 = 4 THEN '7500' ELSE town_code END",
    "bikes_total": "CASE WHEN row_id % 109 = 4 THEN bikes_total + 1 ELSE bikes_total END",
    "station_code": "CASE WHEN row_id % 113 = 5 THEN '00001' WHEN row_id % 131 = 7 THEN 'X9999' ELSE station_code END",
    "town_name": "CASE WHEN row_id % 127 = 6 THEN 'Other' ELSE town_name END",
}
DIRTY_HOURS = "NOT (collected_at >= TIMESTAMP '2024-01-05 03:00:00' AND collected_at < TIMESTAMP '2024-01-05 05:00:00')"


def replaced(df: DataFrame, changes: dict) -> DataFrame:
    return df.selectExpr(*[f"{changes[c]} AS {c}" if c in changes else c for c in df.columns])


def replaced_sql(changes: dict, source: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{text} AS {c}' for c, text in changes.items())}) FROM {source}"


def faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(readings(spark, sf_dir), FAULTY)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(replaced(before(spark, sf_dir), DIRTY).filter(DIRTY_HOURS), "dirty")


# common table expressions for the checking SQL, each naming the ones it needs; they state the rules in the means of the
# checking engine (as-of joins, windows and lists), not in the steps of the jobs
CTES = {
    "readings": ([], READINGS_SQL),
    "versions": ([], VERSIONS_SQL),
    "picks_plain": (["readings", "versions"], """SELECT d.collected_at, v.version_ts FROM (SELECT DISTINCT collected_at FROM readings) d
 ASOF LEFT JOIN (SELECT DISTINCT version_ts FROM versions) v ON d.collected_at >= v.version_ts"""),
    "before_": (["readings", "versions", "picks_plain"], f"""SELECT r.*, c.version_ts, v.station_name, {TYPED_SQL}
 FROM readings r JOIN picks_plain c USING (collected_at) LEFT JOIN versions v USING (version_ts, station_code)"""),
    "dirty_": (["before_"], replaced_sql(DIRTY, f"before_ WHERE {DIRTY_HOURS}")),
    "r1": (["readings"], """SELECT * EXCLUDE (share, newest) REPLACE (CASE WHEN share > 0.5 THEN newest ELSE collected_at END AS collected_at), share > 0.5 AS r1
 FROM (SELECT *, avg(CASE WHEN updated_at - collected_at > INTERVAL 5 MINUTE THEN 1.0 ELSE 0.0 END) OVER poll AS share, max(updated_at) OVER poll AS newest
       FROM readings WINDOW poll AS (PARTITION BY collected_at))"""),
    "codes": (["readings"], "SELECT station_id, list_sort(list_distinct(list(station_code)))[-1] AS known_code FROM readings GROUP BY station_id HAVING count(station_code) > 0"),
    "r2": (["r1"], """SELECT * EXCLUDE (greatest_code) REPLACE (coalesce(station_code, greatest_code) AS station_code), station_code IS NULL AND greatest_code IS NOT NULL AS r2
 FROM (SELECT *, max(station_code) OVER (PARTITION BY station_id) AS greatest_code FROM r1)"""),
    "history": (["r2"], """SELECT station_id, list(row_id ORDER BY collected_at, row_id) AS ids, list({'v': bikes_electric} ORDER BY collected_at, row_id) AS splits FROM r2 GROUP BY station_id"""),
    "r3": (["r2", "history"], """SELECT r2.* EXCLUDE (bikes_electric, bikes_mechanical), CASE WHEN filled THEN least(near, bikes_total) ELSE bikes_electric END AS bikes_electric,
 CASE WHEN filled THEN greatest(bikes_total - near, 0) ELSE bikes_mechanical END AS bikes_mechanical, filled AS r3a
 FROM r2 JOIN (SELECT row_id, coalesce(splits[i - 1].v, splits[i + 1].v) AS near FROM (SELECT unnest(ids) AS row_id, unnest(range(1, len(ids) + 1)) AS i, splits FROM history)) USING (row_id),
 LATERAL (SELECT bikes_electric IS NULL AND near IS NOT NULL AS filled)"""),
    "r3kept": (["r3"], "SELECT * FROM r3 WHERE bikes_electric + bikes_mechanical IS NOT NULL"),
    "valid": (["versions"], f"""SELECT version_ts, station_code, squeezed AS station_name, station_name <> squeezed AS name_fixed, {TYPED_SQL}
 FROM (SELECT *, array_to_string(list_filter(string_split_regex(station_name, '\\s+'), lambda x: x <> ''), ' ') AS squeezed, count(station_name) OVER (PARTITION BY version_ts) AS named FROM versions) v
 WHERE named >= {MIN_NAMED}"""),
    "valid_times": (["valid"], "SELECT DISTINCT version_ts, min(version_ts) OVER () AS first_ts FROM valid"),
    "rejoined": (["r3kept", "valid", "valid_times"], """SELECT r.*, p.version_ts, v.station_name, v.name_fixed, v.capacity, v.latitude, v.longitude, v.town_code, v.town_name
 FROM (SELECT t.row_id AS at_row, coalesce(f.version_ts, (SELECT min(first_ts) FROM valid_times)) AS version_ts FROM r3kept t ASOF LEFT JOIN valid_times f ON t.collected_at >= f.version_ts) p
 JOIN r3kept r ON r.row_id = p.at_row LEFT JOIN valid v ON (v.version_ts, v.station_code) = (p.version_ts, r.station_code)"""),
    "r6": (["rejoined"], "SELECT * FROM rejoined WHERE coalesce(capacity, 1) > 0"),
    "r7": (["r6"], "SELECT * FROM r6 WHERE coalesce(collected_at - updated_at <= INTERVAL 24 HOUR, true)"),
    "r8": (["r7"], "SELECT * FROM r7 WHERE station_code || town_code || station_name IS NOT NULL AND station_id IS NOT NULL"),
    "clean_": (["r8"], "SELECT r8.* FROM r8 SEMI JOIN (SELECT min(row_id) AS row_id FROM r8 GROUP BY station_id, collected_at) USING (row_id)"),
    "station_dim": (["valid", "r3"], """SELECT i.station_id, station_code, d.station_name, d.latitude, d.longitude, d.capacity, d.town_code, d.town_name FROM
 (SELECT station_code, arg_max(struct_pack(station_name, latitude, longitude, capacity, town_code, town_name), version_ts) AS d FROM valid WHERE capacity > 0 GROUP BY station_code)
 JOIN (SELECT station_code, min(station_id) AS station_id FROM r3 WHERE bikes_electric + bikes_mechanical IS NOT NULL GROUP BY station_code) i USING (station_code)"""),
    "town_dim": (["station_dim"], "SELECT town_code, town_name, left(town_code, 2) AS dept_code FROM station_dim GROUP BY ALL"),
    "reading_": (["clean_"], """SELECT {id} AS reading_id, station_id, collected_at, updated_at, docks_free,
 is_installed, is_renting, is_returning, bikes_mechanical, bikes_electric FROM clean_"""),
    "after_": (["reading_", "station_dim", "town_dim"], """SELECT r.reading_id, r.collected_at, r.updated_at, s.station_id, s.station_code, s.station_name, s.latitude, s.longitude,
 s.capacity, s.town_code, t.town_name, r.bikes_mechanical + r.bikes_electric AS bikes_total, r.bikes_mechanical, r.bikes_electric, r.docks_free, r.is_installed
 FROM reading_ r JOIN station_dim s USING (station_id) JOIN town_dim t ON t.town_code = s.town_code"""),
}
# station id, then 18 digits: microseconds since the year 1
READING_ID = "CAST(CAST(station_id AS HUGEINT) * 1000000000000000000 + epoch_us(collected_at) + 62135596800000000 AS DECIMAL(38, 0))"
CTES["reading_"] = (CTES["reading_"][0], CTES["reading_"][1].replace("{id}", READING_ID))


def _needed(names):
    order = []

    def visit(name):
        for parent in CTES[name][0]:
            visit(parent)
        if name not in order:
            order.append(name)

    for n in names:
        visit(n)
    return order


def sql(body: str, *names, extra=(), given=None) -> str:
    """Checking SQL: the named common table expressions with their parents, ``extra`` ones, then ``body``.

    ``given`` replaces the text of some expressions.
    """
    parts = [f"{n} AS MATERIALIZED ({(given or {}).get(n, CTES[n][1])})" for n in _needed(names)] + [f"{n} AS MATERIALIZED ({text})" for n, text in extra]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def union_all(bodies) -> str:
    return reduce(lambda a, b: f"{a} UNION ALL {b}", bodies)
