"""Contract queries: joins, ordering, aggregates and availability reports."""

from datetime import datetime

from pyspark.sql import Window, functions as F

from dockwatch.contract.derived import MIN_NAMED, before, dirty, ntz, readings, sql, table, versions
from dockwatch.contract.feed import messages
from dockwatch.contract.registry import register
from dockwatch.operators import aggregates as A, ordering as O, proximity as P, relations as R
from dockwatch.operators.asof import asof_version
from dockwatch.plans import availability as V
from dockwatch.plans.audit import anomaly_breakdown
from dockwatch.plans.cleaning import known_codes, late_update, r4_valid_versions
from dockwatch.session import materialise
from dockwatch.sources import lake, reference

# --- joins ---------------------------------------------------------------------------------

NEWEST = """(SELECT station_code, station_name, capacity, coordinates, town_name, town_code FROM versions
 WHERE version_ts = (SELECT max(version_ts) FROM versions) AND station_code IS NOT NULL)"""


def enriched(spark, sf_dir):
    flat = lake.flatten_raw_status(messages(spark, sf_dir))
    return R.enrich_latest(flat, reference.newest_version(versions(spark, sf_dir)))


@register("j1_enrich_latest", sql(f"""SELECT r.station_id::VARCHAR AS station_id, r.station_code, CAST(1700000000 + r.row_id AS VARCHAR) AS updated_at,
 n.station_name, n.capacity, n.coordinates, n.town_name, n.town_code, n.station_code IS NOT NULL AS matched
 FROM readings r LEFT JOIN {NEWEST} n ON n.station_code = r.station_code""", "readings", "versions"))
def j1(spark, sf_dir):
    return enriched(spark, sf_dir).select(
        "station_id", "station_code", "updated_at", "station_name", "capacity", "coordinates", "town_name", "town_code", "matched")


@register("j2_unmatched", sql(f"""SELECT count(*) AS messages, count(*) FILTER (WHERE n.station_code IS NULL) AS unmatched
 FROM readings r LEFT JOIN {NEWEST} n ON n.station_code = r.station_code""", "readings", "versions"))
def j2(spark, sf_dir):
    return R.unmatched_count(enriched(spark, sf_dir))


@register("t2_newest_reference", sql("SELECT * FROM versions WHERE version_ts = (SELECT max(version_ts) FROM versions) AND station_code IS NOT NULL", "versions"))
def t2(spark, sf_dir):
    return reference.newest_version(versions(spark, sf_dir))


@register("t9_valid_versions", sql(f"SELECT version_ts FROM versions GROUP BY version_ts HAVING count(station_name) >= {MIN_NAMED}", "versions"))
def t9(spark, sf_dir):
    return reference.valid_versions(versions(spark, sf_dir), MIN_NAMED)


@register("j3_asof", sql("SELECT * FROM picks_plain", "picks_plain"))
def j3(spark, sf_dir):
    return asof_version(readings(spark, sf_dir), versions(spark, sf_dir))


@register("j4_asof_fallback", sql("""SELECT d.collected_at, coalesce(f.version_ts, (SELECT min(first_ts) FROM valid_times)) AS version_ts
 FROM (SELECT DISTINCT collected_at FROM readings) d ASOF LEFT JOIN valid_times f ON d.collected_at >= f.version_ts""", "readings", "valid_times"))
def j4(spark, sf_dir):
    return asof_version(readings(spark, sf_dir), r4_valid_versions(versions(spark, sf_dir), MIN_NAMED), fallback=True)


@register("j5_attach", sql("SELECT * FROM before_", "before_"))
def j5(spark, sf_dir):
    return before(spark, sf_dir)


@register("j6_latest", sql("SELECT row_id, station_id, collected_at, bikes_total FROM readings r QUALIFY collected_at = max(collected_at) OVER (PARTITION BY station_id)", "readings"))
def j6(spark, sf_dir):
    return O.latest_per_key(readings(spark, sf_dir), "station_id", "collected_at").select("row_id", "station_id", "collected_at", "bikes_total")


@register("j7_network_state", sql("SELECT * FROM before_ WHERE collected_at = (SELECT max(collected_at) FROM before_)", "before_"))
def j7(spark, sf_dir):
    return R.network_state(before(spark, sf_dir))


def customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "station_id")


@register("j9_without_readings", """SELECT c_custkey AS station_id, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer c
 WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')""")
def j9(spark, sf_dir):
    """Customers without an urgent order (every customer has some order)."""
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return R.without_readings(customers(spark, sf_dir), urgent.withColumnRenamed("o_custkey", "station_id"))


@register("j10_not_in_list", sql("""SELECT row_id, station_code FROM readings WHERE station_code IS NOT NULL AND station_code NOT IN
 (SELECT station_code FROM versions WHERE extract(day FROM version_ts) % 10 = 3 AND station_code IS NOT NULL)""", "readings", "versions"))
def j10(spark, sf_dir):
    listed = versions(spark, sf_dir).filter(F.dayofmonth("version_ts") % 10 == 3)
    return R.not_in_list(readings(spark, sf_dir), listed, "station_code").select("row_id", "station_code")


@register("j11_keep_groups", sql(f"""SELECT * FROM versions WHERE version_ts IN
 (SELECT version_ts FROM versions GROUP BY version_ts HAVING count(station_name) >= {MIN_NAMED})""", "versions"))
def j11(spark, sf_dir):
    return reference.keep_groups(versions(spark, sf_dir), ["version_ts"], "station_name", MIN_NAMED)


@register("j12_zero_groups", """SELECT n.n_nationkey, n.n_name, count(s.s_suppkey) AS suppliers, CAST(sum(s.s_suppkey) AS BIGINT) AS key_sum
 FROM nation n LEFT JOIN supplier s ON s.s_nationkey = n.n_nationkey GROUP BY 1, 2""")
def j12(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    return R.group_with_zero(nations, suppliers, "n_nationkey", "s_suppkey", "s_suppkey", "suppliers", "key_sum")


@register("j13_update_from", sql("SELECT r.* REPLACE (coalesce(r.station_code, c.known_code) AS station_code) FROM readings r LEFT JOIN codes c ON c.station_id = r.station_id", "readings", "codes"))
def j13(spark, sf_dir):
    feed = readings(spark, sf_dir)
    return R.update_from(feed, known_codes(feed), "station_id", ["station_code"], F.col("station_code").isNull())


FIRST_PER_KEY = "SELECT * FROM readings QUALIFY row_number() OVER (PARTITION BY station_id, collected_at ORDER BY row_id) = 1"


@register("j14_keep_lowest", sql(FIRST_PER_KEY, "readings"))
def j14(spark, sf_dir):
    return O.keep_lowest(readings(spark, sf_dir), ["station_id", "collected_at"])


@register("j15_compare", sql("""SELECT b.station_code, b.version_ts, b.station_name AS station_name_before, a.station_name AS station_name_after
 FROM versions b JOIN valid a ON a.version_ts = b.version_ts AND a.station_code = b.station_code""", "versions", "valid"))
def j15(spark, sf_dir):
    raw = versions(spark, sf_dir)
    return R.compare_on(raw, r4_valid_versions(raw, MIN_NAMED), ["version_ts", "station_code"], ["station_name"])


POINTS = "SELECT c_custkey AS point_id, 48.79 + (c_custkey % 97) * 0.0013 AS point_lat, 2.19 + (c_custkey % 89) * 0.0025 AS point_lon FROM customer"


def points(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("point_id"), (F.lit(48.79) + (k % 97) * F.lit(0.0013)).alias("point_lat"), (F.lit(2.19) + (k % 89) * F.lit(0.0025)).alias("point_lon"))


STATE_CTE = """SELECT * FROM before_ WHERE station_name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY collected_at DESC, row_id DESC) = 1"""


def latest_state(spark, sf_dir):
    """Last reading of each station that has its attributes."""
    return O.latest_by(before(spark, sf_dir).filter(F.col("station_name").isNotNull()), ["station_id"], ["collected_at", "row_id"])


RADIUS = 700
PAIRS = f"""SELECT * FROM (SELECT p.*, s.*, round_even(2 * 6371000 * asin(sqrt(least(sin((radians(s.latitude) - radians(p.point_lat)) / 2) ** 2
 + cos(radians(p.point_lat)) * cos(radians(s.latitude)) * sin((radians(s.longitude) - radians(p.point_lon)) / 2) ** 2, 1.0))), 0) AS distance_m
 FROM points p CROSS JOIN state s WHERE s.is_installed) WHERE distance_m <= {RADIUS}"""
NEAR = [("points", POINTS.replace("0.0013", "0.0013::DOUBLE").replace("0.0025", "0.0025::DOUBLE").replace("48.79", "48.79::DOUBLE").replace("2.19", "2.19::DOUBLE")), ("state", STATE_CTE), ("near", PAIRS)]


def near(spark, sf_dir):
    return P.within_radius(points(spark, sf_dir), materialise(latest_state(spark, sf_dir), "state"), RADIUS)


def positioned(df):
    """Number the rows in the order in which the query gives them (a window over one small report)."""
    return df.withColumn("at", F.monotonically_increasing_id()).withColumn("position", F.row_number().over(Window.orderBy("at"))).drop("at")


@register("j16_radius", sql("""SELECT point_id, station_name, CAST(distance_m AS BIGINT) AS distance_m, bikes_mechanical AS mechanical,
 bikes_electric AS electric, docks_free AS free_docks, row_number() OVER (ORDER BY point_id, distance_m, station_name)::INTEGER AS position FROM near""", "before_", extra=NEAR))
def j16(spark, sf_dir):
    return V.near_list(P.ranked_within_radius(points(spark, sf_dir), materialise(latest_state(spark, sf_dir), "state"), RADIUS))


@register("a14_radius_totals", sql("""SELECT point_id, count(*) AS stations, CAST(sum(bikes_mechanical) AS BIGINT) AS bikes_mechanical,
 CAST(sum(bikes_electric) AS BIGINT) AS bikes_electric FROM near GROUP BY point_id""", "before_", extra=NEAR))
def a14(spark, sf_dir):
    return P.radius_totals(P.within_radius(points(spark, sf_dir), latest_state(spark, sf_dir), RADIUS, summed=["bikes_mechanical", "bikes_electric"]))


@register("u3_append_point", sql("""SELECT point_id, point_lat AS latitude, point_lon AS longitude, '#1f77b4' AS colour, 25::BIGINT AS size FROM points
 UNION ALL SELECT point_id, latitude, longitude, CASE WHEN bikes_mechanical + bikes_electric > 0 THEN '#2ca02c' ELSE '#d62728' END, 15 FROM near""", "before_", extra=NEAR))
def u3(spark, sf_dir):
    return P.append_point(near(spark, sf_dir), points(spark, sf_dir))


# --- ordering ------------------------------------------------------------------------------

@register("w1_neighbours", sql("""SELECT row_id, lag(bikes_electric) OVER w AS previous_value, lead(bikes_electric) OVER w AS next_value FROM readings
 WINDOW w AS (PARTITION BY station_id ORDER BY collected_at, row_id)""", "readings"))
def w1(spark, sf_dir):
    return O.with_neighbours(readings(spark, sf_dir), "bikes_electric")


@register("w2_latest_row", sql("SELECT * FROM readings QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY collected_at DESC, row_id DESC) = 1", "readings"))
def w2(spark, sf_dir):
    return O.latest_by(readings(spark, sf_dir), ["station_id"], ["collected_at", "row_id"])


@register("w3_first_row", """SELECT * FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name, c_custkey) = 1""")
def w3(spark, sf_dir):
    return O.first_by(table(spark, sf_dir, "customer"), ["c_nationkey"], ["c_name", "c_custkey"])


@register("w4_dedup", sql(FIRST_PER_KEY, "readings"))
def w4(spark, sf_dir):
    return O.dedup(readings(spark, sf_dir))


@register("w5_top_k", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def w5(spark, sf_dir):
    return O.top_k(table(spark, sf_dir, "orders"), [F.desc("o_totalprice"), "o_orderkey"], 15)


@register("w6_ranked_order", """SELECT o_orderkey, o_orderpriority, o_custkey, row_number() OVER (ORDER BY CASE o_orderpriority WHEN '3-MEDIUM' THEN 0 WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN 2
 ELSE 3 END, o_custkey, o_orderkey) AS position FROM orders""")
def w6(spark, sf_dir):
    """All orders in a fixed order of priorities."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    return O.with_position(orders, O.rank_of("o_orderpriority", ["3-MEDIUM", "1-URGENT", "5-LOW"]), "o_custkey", "o_orderkey")


@register("w6_ranked_segments", """SELECT c_mktsegment, c_nationkey, n, row_number() OVER (ORDER BY CASE c_mktsegment WHEN 'MACHINERY' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'AUTOMOBILE' THEN 2
 ELSE 3 END, c_nationkey, c_mktsegment)::INTEGER AS position FROM (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL)""")
def w6_segments(spark, sf_dir):
    counts = table(spark, sf_dir, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))
    return positioned(O.order_by_rank(counts, "c_mktsegment", ["MACHINERY", "BUILDING", "AUTOMOBILE"], "c_nationkey", "c_mktsegment"))


@register("u1_stack", """SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_acctbal < 0""")
def u1(spark, sf_dir):
    """Three lists one after the other, copies kept, columns matched by name."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_acctbal")
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return R.stack(c.select("id", "name"), s, c.filter("c_acctbal < 0").select("id", "name"))


@register("a10_table_counts", """SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
 UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def a10(spark, sf_dir):
    return A.table_counts({n: table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem")})


@register("u2_distinct", sql("SELECT DISTINCT station_id, station_code FROM readings", "readings"))
def u2(spark, sf_dir):
    return R.distinct_keys(readings(spark, sf_dir), "station_id", "station_code")


# --- aggregates ----------------------------------------------------------------------------

@register("a1_filtered_count", """SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE l_discount > 0.05) AS discounted FROM lineitem GROUP BY l_returnflag""")
def a1(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), A.anomaly_count(F.col("l_discount") > 0.05).alias("discounted"))


@register("a2_tuple_distinct", sql("SELECT count(*) AS n_rows, count(DISTINCT (station_code, collected_at)) AS n_tuples FROM readings", "readings"))
def a2(spark, sf_dir):
    return A.tuple_distinct(readings(spark, sf_dir), "station_code", "collected_at")


@register("a3_majority", sql("""SELECT collected_at, count(*) AS n, count(*) FILTER (WHERE updated_at > collected_at + INTERVAL '5' MINUTE) AS n_true FROM readings
 GROUP BY 1 HAVING count(*) FILTER (WHERE updated_at > collected_at + INTERVAL '5' MINUTE) > count(*) / 2""", "readings"))
def a3(spark, sf_dir):
    return A.majority_groups(readings(spark, sf_dir), "collected_at", late_update())


@register("a4_multi_valued", """SELECT count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS n_multi FROM
 (SELECT c_nationkey, count(DISTINCT c_mktsegment) AS n FROM customer WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey)""")
def a4(spark, sf_dir):
    return A.multi_valued(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment")


KPI = """SELECT count(*) AS stations, CAST(coalesce(sum(bikes_mechanical + bikes_electric), 0) AS BIGINT) AS bikes, CAST(coalesce(sum(bikes_electric), 0) AS BIGINT) AS electric,
 count(*) FILTER (WHERE bikes_mechanical + bikes_electric = 0) AS empty_stations, count(*) FILTER (WHERE docks_free = 0) AS full_stations,
 CAST(coalesce(sum(bikes_electric), 0) AS DOUBLE) / greatest(coalesce(sum(bikes_mechanical + bikes_electric), 0), 1) AS electric_share"""
STATE = [("state", STATE_CTE)]


@register("a5_kpis", sql(f"{KPI} FROM state", "before_", extra=STATE))
def a5(spark, sf_dir):
    return V.kpis(latest_state(spark, sf_dir))


@register("a5_kpis_last_collection", sql(f"{KPI} FROM before_ WHERE collected_at = (SELECT max(collected_at) FROM before_)", "before_"))
def a5b(spark, sf_dir):
    return V.kpis(R.network_state(before(spark, sf_dir)))


NOW = datetime(2024, 1, 30, 22, 0)


@register("a6_series", sql("""SELECT collected_at, CAST(sum(bikes_mechanical) AS BIGINT) AS mechanical, CAST(sum(bikes_electric) AS BIGINT) AS electric,
 row_number() OVER (ORDER BY collected_at)::INTEGER AS position FROM readings
 WHERE collected_at > TIMESTAMP '2024-01-30 22:00:00' - INTERVAL '24' HOUR GROUP BY 1""", "readings"))
def a6(spark, sf_dir):
    return positioned(V.series_24h(readings(spark, sf_dir), ntz(F.lit(NOW))))


@register("a7_top_towns", sql("""SELECT town_name, CAST(sum(bikes_mechanical) AS BIGINT) AS mechanical, CAST(sum(bikes_electric) AS BIGINT) AS electric,
 CAST(sum(bikes_mechanical + bikes_electric) AS BIGINT) AS total FROM state WHERE town_name <> 'Town 0' GROUP BY 1 ORDER BY total DESC, town_name LIMIT 15""", "before_", extra=STATE))
def a7(spark, sf_dir):
    return V.top_towns(latest_state(spark, sf_dir), exclude="Town 0")


@register("a8_fill_rate", sql("""SELECT *, row_number() OVER (ORDER BY fill_pct, town_name)::INTEGER AS position FROM
 (SELECT town_name, count(station_name) AS stations, round_even(avg((bikes_mechanical + bikes_electric)::DOUBLE / nullif(capacity, 0)) * 100, 1) AS fill_pct
 FROM state GROUP BY 1 HAVING count(station_name) >= 5)""", "before_", extra=STATE))
def a8(spark, sf_dir):
    return positioned(V.fill_rate(latest_state(spark, sf_dir)))


@register("a13_missing_slots", sql("""SELECT CAST(epoch(max(h) - min(h)) / 3600 + 1 AS BIGINT) AS expected,
 CAST(epoch(max(h) - min(h)) / 3600 + 1 - count(DISTINCT h) AS BIGINT) AS missing FROM (SELECT date_trunc('hour', collected_at) AS h FROM readings)""", "readings"))
def a13(spark, sf_dir):
    return A.missing_slots(readings(spark, sf_dir), cadence="hour")


@register("a15_empty_stations", sql("""SELECT station_code, station_name, town_name, capacity, docks_free FROM before_ WHERE bikes_mechanical + bikes_electric = 0""", "before_"))
def a15(spark, sf_dir):
    return V.empty_stations(before(spark, sf_dir))


@register("a15_full_count", sql("SELECT count(*) FILTER (WHERE docks_free = 0) AS full_stations FROM readings", "readings"))
def a15b(spark, sf_dir):
    return V.full_count(readings(spark, sf_dir))


@register("a16_changed_without_update", sql("""SELECT * EXCLUDE (pm, pe, pu, rn) FROM (SELECT *, lag(bikes_mechanical) OVER w AS pm, lag(bikes_electric) OVER w AS pe,
 lag(updated_at) OVER w AS pu, row_number() OVER w AS rn FROM readings WINDOW w AS (PARTITION BY station_id ORDER BY collected_at, row_id))
 WHERE rn > 1 AND updated_at = pu AND (bikes_mechanical IS DISTINCT FROM pm OR bikes_electric IS DISTINCT FROM pe)""", "readings"))
def a16(spark, sf_dir):
    return A.changed_without_update(readings(spark, sf_dir))


BREAKDOWN = """SELECT {by}, count(*) AS n_readings, count(DISTINCT station_id) AS n_stations, max(bikes_total + docks_free - capacity) AS max_excess
 FROM before_ WHERE {cond} GROUP BY {by}"""


@register("a17_breakdown_k2", sql(BREAKDOWN.format(by="version_ts", cond="bikes_total + docks_free > capacity"), "before_"))
def a17(spark, sf_dir):
    return anomaly_breakdown(before(spark, sf_dir), "K2", ["version_ts"])


@register("a17_breakdown_c3", sql(BREAKDOWN.format(by="collected_at", cond="station_name IS NULL OR capacity IS NULL OR latitude IS NULL OR longitude IS NULL OR town_code IS NULL OR town_name IS NULL"), "before_"))
def a17b(spark, sf_dir):
    return anomaly_breakdown(before(spark, sf_dir), "C3", ["collected_at"])


def grouped_breakdown(name, check_id, by, failing):
    """Breakdown of a check on groups, over the rows with planted faults."""
    @register(name, sql(f"""SELECT {by}, count(*) AS n_readings, count(DISTINCT station_id) AS n_stations, max(bikes_total + docks_free - capacity) AS max_excess
 FROM ({failing}) GROUP BY {by}""", "dirty_", "versions"))
    def run(spark, sf_dir):
        return anomaly_breakdown(dirty(spark, sf_dir), check_id, [by], versions(spark, sf_dir))
    return run


grouped_breakdown("a17_breakdown_u1", "U1", "station_id", "SELECT * FROM dirty_ QUALIFY row_number() OVER (PARTITION BY station_id, collected_at ORDER BY row_id) > 1")
grouped_breakdown("a17_breakdown_u2", "U2", "station_code", "SELECT * FROM dirty_ WHERE station_code IN (SELECT station_code FROM dirty_ GROUP BY 1 HAVING min(station_id) <> max(station_id))")
grouped_breakdown("a17_breakdown_k4", "K4", "town_code", "SELECT * FROM dirty_ WHERE town_code IN (SELECT town_code FROM dirty_ GROUP BY 1 HAVING min(town_name) <> max(town_name))")
grouped_breakdown("a17_breakdown_i1", "I1", "station_code", "SELECT d.* FROM dirty_ d ANTI JOIN versions v ON v.station_code = d.station_code WHERE d.station_code IS NOT NULL")


@register("a17_breakdown_c4", sql("""SELECT CAST(h AS DATE) AS day, count(*) AS n_readings, 0::BIGINT AS n_stations, CAST(NULL AS BIGINT) AS max_excess
 FROM (SELECT unnest(generate_series(min(collected_at), max(collected_at), INTERVAL 1 HOUR)) AS h FROM dirty_) WHERE h NOT IN (SELECT collected_at FROM dirty_) GROUP BY 1""", "dirty_"))
def a17_c4(spark, sf_dir):
    return anomaly_breakdown(dirty(spark, sf_dir), "C4", ["day"], cadence="hour")


# orders stand for versions of a customer's attributes
@register("a18_reference_changes", """SELECT station_code, version_ts, p_before AS o_orderpriority_before, s_before AS o_orderstatus_before,
 o_orderpriority AS o_orderpriority_after, o_orderstatus AS o_orderstatus_after FROM (
 SELECT *, lag(o_orderpriority) OVER w AS p_before, lag(o_orderstatus) OVER w AS s_before, row_number() OVER w AS rn FROM (
  SELECT CAST(o_custkey AS VARCHAR) AS station_code, o_orderdate AS version_ts, o_orderpriority, o_orderstatus FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderpriority DESC, o_orderstatus DESC) = 1)
 WINDOW w AS (PARTITION BY station_code ORDER BY version_ts))
 WHERE rn > 1 AND (o_orderpriority <> p_before OR o_orderstatus <> s_before)""")
def a18(spark, sf_dir):
    v = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("station_code"), F.col("o_orderdate").alias("version_ts"), "o_orderpriority", "o_orderstatus")
    return A.reference_changes(v, ("o_orderpriority", "o_orderstatus"))


@register("l13_enrich_towns", sql("""SELECT t.town_code, t.town_name, t.dept_code, CAST(n.n_nationkey * 1000 AS INTEGER) AS population, CAST(n.n_nationkey + 0.5 AS DECIMAL(10,2)) AS area_ha
 FROM (SELECT DISTINCT town_code, town_name, left(town_code, 2) AS dept_code FROM versions WHERE town_code IS NOT NULL) t
 LEFT JOIN nation n ON CAST(75000 + n.n_nationkey * 2 AS VARCHAR) = t.town_code""", "versions"))
def l13(spark, sf_dir):
    from dockwatch.operators import load
    n = F.col("n_nationkey")
    admin = table(spark, sf_dir, "nation").select(
        (75000 + n * 2).cast("string").alias("code"), (n * 1000).alias("population"), (n + F.lit(0.5)).alias("surface"))
    towns = load.towns_of(versions(spark, sf_dir).filter(F.col("town_code").isNotNull()))
    return load.enrich_towns(towns, admin)


@register("l14_station_from_feeds", sql("""SELECT s_suppkey AS station_id, lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS station_code, s_name AS station_name,
 48.0::DOUBLE + s_suppkey / 1000.0::DOUBLE AS latitude, 2.0::DOUBLE + s_nationkey / 100.0::DOUBLE AS longitude, CAST(20 + s_nationkey AS BIGINT) AS capacity, v.town_code
 FROM supplier LEFT JOIN (SELECT station_code, max(town_code) AS town_code FROM versions WHERE station_code IS NOT NULL GROUP BY 1) v
 ON v.station_code = lpad(CAST(s_suppkey AS VARCHAR), 5, '0')""", "versions"))
def l14(spark, sf_dir):
    from dockwatch.operators import load
    k = F.col("s_suppkey")
    info = table(spark, sf_dir, "supplier").select(
        k.alias("station_id"), F.lpad(k.cast("string"), 5, "0").alias("stationCode"), F.col("s_name").alias("name"),
        (F.lit(48.0) + k / F.lit(1000.0)).alias("lat"), (F.lit(2.0) + F.col("s_nationkey") / F.lit(100.0)).alias("lon"),
        (20 + F.col("s_nationkey")).alias("capacity"))
    return load.station_from_feeds(info, versions(spark, sf_dir))
