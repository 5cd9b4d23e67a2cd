"""Contract queries: audit, repair rules, dimensional load and comparison."""

from pyspark.sql import functions as F

from dockwatch import schemas as S
from dockwatch.contract.analytics import positioned
from dockwatch.contract.derived import (
    FAULTY, MIN_NAMED, READING_ID, READINGS_SQL, before, before_of, dirty, faulty, readings, replaced, replaced_sql, sql, union_all, versions,
)
from dockwatch.contract.registry import register
from dockwatch.operators import constraints, load
from dockwatch.operators.aggregates import incomplete_children, under_capacity
from dockwatch.operators.ordering import dedup, latest_by, latest_per_key
from dockwatch.operators.relations import group_with_zero, star_join, unpivot_types
from dockwatch.plans import audit as Q, cleaning as C, conformance as L
from dockwatch.session import materialise

# --- checks --------------------------------------------------------------------------------

LABELS = "(VALUES " + ", ".join(f"('{i}', '{d}', '{label}')" for i, d, label, *_ in S.CHECKS) + ") AS c(check_id, dimension, label)"


def audit_sql(source, phase, codes="versions", cadence="hour"):
    """Checking SQL of all checks on one relation: one aggregate for the row checks, one per kind of group."""
    row = {
        "C1": ("true", "station_code IS NULL"),
        "C2": ("true", "bikes_mechanical + bikes_electric IS NULL"),
        "C3": ("true", "list_contains([station_name IS NULL, capacity IS NULL, latitude + longitude IS NULL, town_code IS NULL, town_name IS NULL], true)"),
        "V1": ("capacity IS NOT NULL", "NOT capacity > 0"),
        "V2": ("true", "least(bikes_total, bikes_mechanical, bikes_electric, docks_free) < 0"),
        "V3": ("latitude IS NOT NULL", "abs(latitude - 48.7) > 0.6 OR abs(longitude - 2.5) > 1.1"),
        "V4": ("town_code IS NOT NULL", "NOT regexp_full_match(town_code, '(75|77|78|91|92|93|94|95)[0-9]{3}')"),
        "V5": ("station_name IS NOT NULL", r"regexp_matches(station_name, '^ | $|\s\s')"),
        "V6": ("true", "updated_at - collected_at > INTERVAL 5 MINUTE"),
        "K1": ("bikes_mechanical + bikes_electric IS NOT NULL", "bikes_total - bikes_mechanical <> bikes_electric"),
        "K2": ("capacity IS NOT NULL", "capacity - bikes_total < docks_free"),
        "K3": ("true", "collected_at - updated_at > INTERVAL 24 HOUR"),
        "I2": ("true", "coalesce(station_id::VARCHAR || station_code || town_code, '') = ''"),
    }
    counted = ", ".join(f"struct_pack(id := '{i}', n := count_if({n}), bad := coalesce(count_if({bad}), 0))" for i, (n, bad) in row.items())
    slots = f"SELECT date_trunc('{cadence}', collected_at) AS slot FROM {source}"
    parts = [
        f"SELECT f.id AS check_id, f.n::BIGINT AS n_checked, f.bad::BIGINT AS n_anomalies FROM (SELECT unnest([{counted}]) AS f FROM {source})",
        f"""SELECT 'C4', len(every), len(every) - len(seen) FROM (SELECT generate_series(min(slot), max(slot), INTERVAL 1 {cadence}) AS every, list_distinct(list(slot)) AS seen FROM ({slots}))""",
        f"SELECT 'U1', sum(n)::BIGINT, sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM {source} GROUP BY station_id, collected_at)",
        f"SELECT 'U2', count(*), count_if(lo < hi) FROM (SELECT min(station_id) AS lo, max(station_id) AS hi FROM {source} GROUP BY station_code HAVING station_code IS NOT NULL)",
        f"SELECT 'K4', count(*), count_if(lo < hi) FROM (SELECT min(town_name) AS lo, max(town_name) AS hi FROM {source} GROUP BY town_code HAVING town_code IS NOT NULL)",
        f"SELECT 'I1', count(*), count(*) - count(k.code) FROM {source} s LEFT JOIN (SELECT DISTINCT station_code AS code FROM {codes}) k ON k.code = s.station_code WHERE s.station_code IS NOT NULL",
    ]
    return f"""SELECT '{phase}' AS phase, r.check_id, c.dimension, c.label, r.n_checked::BIGINT AS n_checked, r.n_anomalies::BIGINT AS n_anomalies,
 round(100.0::DOUBLE * r.n_anomalies / nullif(r.n_checked, 0), 2) AS rate_pct FROM ({union_all(parts)}) r JOIN {LABELS} USING (check_id)"""


def stored(spark, sf_dir):
    """Stored "before" table and its reference."""
    return before(spark, sf_dir, stored=True), versions(spark, sf_dir)


def repaired(spark, sf_dir, rows=None):
    rows = stored(spark, sf_dir)[0] if rows is None else materialise(rows, "before")
    ref = versions(spark, sf_dir)
    result = C.repair(rows, ref, MIN_NAMED)
    return result, materialise(result.clean, "clean")


@register("q_audit_before", sql(audit_sql("before_", "before"), "before_"))
def q_before(spark, sf_dir):
    rows, ref = stored(spark, sf_dir)
    return Q.audit(rows, ref, "before", cadence="hour")


@register("q_audit_dirty", sql(audit_sql("dirty_", "dirty"), "dirty_"))
def q_dirty(spark, sf_dir):
    """Rows with planted faults: every one of the eighteen checks finds some."""
    return Q.audit(dirty(spark, sf_dir), versions(spark, sf_dir), "dirty", cadence="hour")


@register("q_audit_minutes", sql(audit_sql("dirty_", "minutes", cadence="minute"), "dirty_"))
def q_minutes(spark, sf_dir):
    """The same at the default cadence of one collection a minute."""
    return Q.audit(dirty(spark, sf_dir), versions(spark, sf_dir), "minutes")


@register("q_audit_after", sql(audit_sql("after_", "after"), "after_"))
def q_after(spark, sf_dir):
    result, clean = repaired(spark, sf_dir)
    after = materialise(L.read_back(L.target_tables(result, clean)), "after")
    return Q.audit(after, result.reference, "after", cadence="hour")


CLEAN_AUDIT = audit_sql("clean_", "clean")


@register("q_audit_clean", sql(CLEAN_AUDIT, "clean_"))
def q_clean(spark, sf_dir):
    """K1 on the repaired rows themselves: after the load the total is recomputed from its parts."""
    result, clean = repaired(spark, sf_dir)
    return Q.audit(clean, result.reference, "clean", cadence="hour")


DIMENSIONS = "['Completeness', 'Uniqueness', 'Validity', 'Consistency', 'Integrity']"


@register("q_compare", sql(f"""SELECT row_number() OVER (ORDER BY list_position({DIMENSIONS}, b.dimension), b.check_id)::INTEGER AS position, b.check_id, b.dimension, b.label, b.n_anomalies AS anomalies_before, b.rate_pct AS rate_before, a.n_anomalies AS anomalies_after,
 a.rate_pct AS rate_after, CASE WHEN a.n_anomalies = 0 THEN 'OK' WHEN a.n_anomalies < b.n_anomalies THEN 'reduced' ELSE 'accepted' END AS status
 FROM b JOIN a ON a.check_id = b.check_id""", "before_", "after_", extra=[("b", audit_sql("before_", "before")), ("a", audit_sql("after_", "after"))]))
def q_compare(spark, sf_dir):
    rows, ref = stored(spark, sf_dir)
    return positioned(L.audit_path(rows, ref, MIN_NAMED, cadence="hour")["comparison"])


CATALOGUE = "(VALUES " + ", ".join(f"('{i}', '{crit}', '{target}', '{action}')" for i, _, _, crit, target, action in S.CHECKS) + ") AS k(check_id, criticality, target, action)"


@register("q_catalogue", sql(f"""SELECT b.*, k.criticality, k.target, k.action, CASE WHEN target = '0' THEN n_anomalies = 0 WHEN target = '< 5 %' THEN coalesce(rate_pct < 5, true) END AS passed
 FROM b JOIN {CATALOGUE} ON k.check_id = b.check_id""", "before_", extra=[("b", audit_sql("before_", "before"))]))
def q_catalogue(spark, sf_dir):
    return Q.add_catalogue(q_before(spark, sf_dir))


# the base the live path would hold: usable rows only, no repair
LIVE = """SELECT *, row_id AS reading_id FROM before_ WHERE capacity > 0 AND docks_free >= 0 AND town_code IS NOT NULL AND station_name IS NOT NULL AND station_code IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY station_id, collected_at ORDER BY row_id) = 1"""
LIVE_STATION = "SELECT * FROM live QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY collected_at DESC, row_id DESC) = 1"
UNTIL = "(SELECT max(collected_at) FROM before_)"


def base_sql(station, town, reading):
    """The nine figures from one aggregate per table, readings up to the last collection of the unrepaired base."""
    r = f"(SELECT * FROM {reading} WHERE collected_at <= {UNTIL})"
    facts = f"""SELECT count(*) AS n, count(DISTINCT collected_at) AS polls, count_if(bikes_mechanical + bikes_electric IS NULL) AS incomplete,
 count_if(collected_at - updated_at > INTERVAL 24 HOUR) AS silent, count_if(updated_at - collected_at > INTERVAL 5 MINUTE) AS late FROM {r}"""
    stations = rf"""SELECT count(*) AS n, count_if(regexp_matches(station_name, '^ | $|\s\s')) AS spaced, count_if(used.station_id IS NULL) AS unused
 FROM {station} s LEFT JOIN (SELECT DISTINCT station_id FROM {r}) used ON used.station_id = s.station_id"""
    return f"""SELECT unnest([1, 2, 3, 4, 5, 6, 7, 8, 9]) AS position, unnest([f.n, s.n, t.n, f.polls, f.incomplete, s.unused, f.silent, f.late, s.spaced])::BIGINT AS n
 FROM ({facts}) f, ({stations}) s, (SELECT count(DISTINCT town_code) AS n FROM {town}) t"""


INDICATOR_VALUES = "(VALUES " + ", ".join(f"({i}, '{name}')" for i, name in enumerate(L.INDICATORS, 1)) + ") AS i(position, indicator)"


def live_tables(rows):
    """Target tables of the live path; a missing bike type has no row here, so incomplete readings show."""
    usable = rows.filter(
        (F.col("capacity") > 0) & (F.col("docks_free") >= 0) & F.col("town_code").isNotNull() & F.col("station_name").isNotNull()
        & F.col("station_code").isNotNull())
    kept = materialise(load.with_reading_id(dedup(usable)), "live")
    types = load.seed_types(rows.sparkSession)
    newest = latest_by(kept.select(*load.STATION_COLUMNS, "town_name", "collected_at", "row_id"), ["station_id"], ["collected_at", "row_id"])
    stations = materialise(newest, "stations")  # both dimensions are made of it
    return {
        "town": load.build_town_dim(stations), "station": stations.select(*load.STATION_COLUMNS), "bike_type": types,
        "reading": kept.select(*load.READING_COLUMNS),
        "reading_bikes": load.insert_children(kept.withColumn("date", F.to_date("collected_at")), types, ["reading_id", "date"]).filter(F.col("bikes").isNotNull()),
    }


@register("q_base", sql(f"""SELECT i.position, i.indicator, l.n AS live, r.n AS repaired, r.n - l.n AS difference
 FROM l JOIN r ON r.position = l.position JOIN {INDICATOR_VALUES} ON i.position = l.position""", "before_", "reading_", "station_dim", "town_dim", extra=[
    ("live", LIVE), ("live_station", LIVE_STATION),
    ("l", base_sql("live_station", "live_station", "live")), ("r", base_sql("station_dim", "town_dim", "reading_"))]))
def q_base(spark, sf_dir):
    result, clean = repaired(spark, sf_dir)
    rows = before(spark, sf_dir)
    return L.base_vs_base(live_tables(rows), L.target_tables(result, clean), rows.agg(F.max("collected_at")).scalar())


@register("a12_incomplete_children", sql("""SELECT row_id AS reading_id, CAST((bikes_mechanical IS NOT NULL)::INT + (bikes_electric IS NOT NULL)::INT AS BIGINT) AS n_children
 FROM readings WHERE bikes_mechanical IS NULL OR bikes_electric IS NULL""", "readings"))
def a12(spark, sf_dir):
    rows = readings(spark, sf_dir).withColumnRenamed("row_id", "reading_id")
    children = load.insert_children(rows, load.seed_types(spark)).filter(F.col("bikes").isNotNull())
    return incomplete_children(rows.select("reading_id"), children)


def target(spark, sf_dir):
    result, clean = repaired(spark, sf_dir)
    return L.target_tables(result, clean)


@register("qt1_stations_per_town", sql("""SELECT t.town_code, t.town_name, t.dept_code, CAST(NULL AS INTEGER) AS population, CAST(NULL AS DECIMAL(10,2)) AS area_ha,
 count(s.station_id) AS stations, CAST(sum(s.capacity) AS BIGINT) AS docks FROM town_dim t LEFT JOIN station_dim s ON s.town_code = t.town_code GROUP BY ALL""", "town_dim", "station_dim"))
def qt1a(spark, sf_dir):
    tables = target(spark, sf_dir)
    return group_with_zero(tables["town"], tables["station"], "town_code", "station_id", "capacity")


@register("qt1_latest_detail", sql("""SELECT station_code, station_name, collected_at, bikes_mechanical, bikes_electric, docks_free, capacity
 FROM after_ QUALIFY collected_at = max(collected_at) OVER (PARTITION BY station_id)""", "after_"))
def qt1b(spark, sf_dir):
    flat = star_join(target(spark, sf_dir))
    latest = latest_per_key(flat, "station_id", "collected_at")
    return latest.select("station_code", "station_name", "collected_at", "bikes_mechanical", "bikes_electric", "docks_free", "capacity")


@register("a11_under_capacity", sql("""SELECT station_code, station_name, collected_at, capacity, bikes_total + docks_free AS observed
 FROM after_ WHERE bikes_total + docks_free < capacity""", "after_"))
def a11(spark, sf_dir):
    return under_capacity(target(spark, sf_dir))


# --- repair rules --------------------------------------------------------------------------

R_COLUMNS = "row_id, station_id, station_code, collected_at, updated_at, bikes_total, bikes_mechanical, bikes_electric, docks_free, is_installed, is_renting, is_returning"


def rule(name, body, *needs):
    return register(name, sql(body, *needs))


def working(spark, sf_dir):
    return C.r0_working_set(readings(spark, sf_dir).withColumn("station_name", F.lit(None).cast("string"))).drop("had_no_name")


def working_columns(df, *flags):
    return df.select(*[c.strip() for c in R_COLUMNS.split(",")], *flags)


@rule("r0_working_set", f"SELECT {R_COLUMNS} FROM before_", "before_")
def r0(spark, sf_dir):
    return working_columns(C.r0_working_set(before(spark, sf_dir)))


@rule("r1_clock", f"SELECT {R_COLUMNS}, r1 FROM r1", "r1")
def r1(spark, sf_dir):
    return working_columns(C.r1_clock(working(spark, sf_dir)), "r1")


@rule("r2_code", f"SELECT {R_COLUMNS}, r2 FROM r2", "r2")
def r2(spark, sf_dir):
    return working_columns(C.r2_code(C.r1_clock(working(spark, sf_dir))), "r2")


def after_r3(spark, sf_dir):
    return C.r3_impute(C.r2_code(C.r1_clock(working(spark, sf_dir))))


@rule("r3_impute", f"SELECT {R_COLUMNS}, r3a FROM r3", "r3")
def r3(spark, sf_dir):
    return working_columns(after_r3(spark, sf_dir), "r3a")


@rule("r3_drop", f"SELECT {R_COLUMNS} FROM r3kept", "r3kept")
def r3b(spark, sf_dir):
    return working_columns(C.r3_drop(after_r3(spark, sf_dir)))


@rule("r4_valid_versions", "SELECT * FROM valid", "valid")
def r4a(spark, sf_dir):
    return C.r4_valid_versions(versions(spark, sf_dir), MIN_NAMED)


@rule("r4_dropped_rows", f"SELECT count(*) AS n FROM versions WHERE version_ts IN (SELECT version_ts FROM versions GROUP BY version_ts HAVING count(station_name) < {MIN_NAMED})", "versions")
def r4d(spark, sf_dir):
    return C.r4_dropped_rows(versions(spark, sf_dir), MIN_NAMED)


ATTRIBUTES = "version_ts, station_name, name_fixed, capacity, latitude, longitude, town_code, town_name"


def rejoined(spark, sf_dir):
    valid = C.r4_valid_versions(versions(spark, sf_dir), MIN_NAMED)
    rows = materialise(C.r3_drop(after_r3(spark, sf_dir)), "r3")
    return C.r4_rejoin(rows, valid)


def attributes(df):
    return working_columns(df, *[c.strip() for c in ATTRIBUTES.split(",")])


@rule("r4_rejoin", f"SELECT {R_COLUMNS}, {ATTRIBUTES} FROM rejoined", "rejoined")
def r4b(spark, sf_dir):
    return attributes(rejoined(spark, sf_dir))


@rule("r5_names", "SELECT row_id, station_name FROM rejoined WHERE name_fixed", "rejoined")
def r5(spark, sf_dir):
    return rejoined(spark, sf_dir).filter("name_fixed").select("row_id", "station_name")


@rule("r6_capacity", f"SELECT {R_COLUMNS}, {ATTRIBUTES} FROM r6", "r6")
def r6(spark, sf_dir):
    return attributes(C.r6_capacity(rejoined(spark, sf_dir)))


@rule("r7_silent", f"SELECT {R_COLUMNS}, {ATTRIBUTES} FROM r7", "r7")
def r7(spark, sf_dir):
    return attributes(C.r7_silent(C.r6_capacity(rejoined(spark, sf_dir))))


@rule("r8_unattached", f"SELECT {R_COLUMNS}, {ATTRIBUTES} FROM r8", "r8")
def r8(spark, sf_dir):
    return attributes(C.r8_unattached(C.r7_silent(C.r6_capacity(rejoined(spark, sf_dir)))))


CLEAN_COLUMNS = f"{R_COLUMNS}, station_name, capacity, latitude, longitude, town_code, town_name"


@rule("r9_dedup", f"SELECT {R_COLUMNS}, {ATTRIBUTES} FROM clean_", "clean_")
def r9(spark, sf_dir):
    return attributes(C.r9_dedup(C.r8_unattached(C.r7_silent(C.r6_capacity(rejoined(spark, sf_dir))))))


@rule("r10_kept", f"SELECT {CLEAN_COLUMNS} FROM clean_ WHERE bikes_total + docks_free > capacity", "clean_")
def r10(spark, sf_dir):
    _, clean = repaired(spark, sf_dir)
    return C.r10_kept(clean).select(*[c.strip() for c in CLEAN_COLUMNS.split(",")])


@rule("r_repair", f"SELECT {CLEAN_COLUMNS}, r1 AS time_corrected, r3a AS split_imputed FROM clean_", "clean_")
def r_repair(spark, sf_dir):
    _, clean = repaired(spark, sf_dir)
    return clean.select(*[c.strip() for c in CLEAN_COLUMNS.split(",")], "time_corrected", "split_imputed")


COUNTS = [
    "SELECT count(*) FROM r1 WHERE r1", "SELECT count(*) FROM r2 WHERE r2", "SELECT count(*) FROM r3 WHERE r3a",
    "SELECT (SELECT count(*) FROM r3) - (SELECT count(*) FROM r3kept)",
    f"SELECT count(*) FROM versions WHERE version_ts IN (SELECT version_ts FROM versions GROUP BY version_ts HAVING count(station_name) < {MIN_NAMED})",
    "SELECT count(*) FROM rejoined n JOIN before_ b ON b.row_id = n.row_id WHERE b.station_name IS NULL AND n.station_name IS NOT NULL",
    "SELECT count(*) FROM rejoined WHERE name_fixed", "SELECT (SELECT count(*) FROM rejoined) - (SELECT count(*) FROM r6)",
    "SELECT (SELECT count(*) FROM r6) - (SELECT count(*) FROM r7)", "SELECT (SELECT count(*) FROM r7) - (SELECT count(*) FROM r8)",
    "SELECT (SELECT count(*) FROM r8) - (SELECT count(*) FROM clean_)", "SELECT count(*) FROM clean_ WHERE bikes_total + docks_free > capacity",
]
JOURNAL_SQL = union_all(
    f"SELECT {o}::BIGINT AS step, '{name}' AS rule, '{check}' AS check_id, '{action}' AS action, CAST(({count}) AS BIGINT) AS n_rows"
    for (o, name, check, action), count in zip(C.JOURNAL, COUNTS))
JOURNAL_SQL = f"SELECT *, row_number() OVER (ORDER BY step, rule)::INTEGER AS position FROM ({JOURNAL_SQL})"


@rule("r_journal", JOURNAL_SQL, "clean_", "before_")
def r_journal(spark, sf_dir):
    result, clean = repaired(spark, sf_dir)
    return positioned(C.journal(result, clean, MIN_NAMED))


@register("r_journal_faulty", sql(JOURNAL_SQL, "clean_", "before_", given={"readings": replaced_sql(FAULTY, f"({READINGS_SQL})")}))
def r_journal_faulty(spark, sf_dir):
    """Readings with splits that cannot be imputed and codes that no version knows: every rule touches some."""
    result, clean = repaired(spark, sf_dir, before_of(faulty(spark, sf_dir), versions(spark, sf_dir)))
    return positioned(C.journal(result, clean, MIN_NAMED))


# --- load ----------------------------------------------------------------------------------

HAS_STATION = "station_name IS NOT NULL AND station_code IS NOT NULL"
OLD = "collected_at < TIMESTAMP '2024-01-20 00:00:00'"
# for every third station the next batch is late: it holds older readings than the ones loaded
NEW = """CASE WHEN station_id % 3 = 0 THEN collected_at >= TIMESTAMP '2024-01-10 00:00:00' AND collected_at < TIMESTAMP '2024-01-12 00:00:00'
 ELSE collected_at >= TIMESTAMP '2024-01-15 00:00:00' END"""
STATION = ", ".join(load.STATION_COLUMNS)


def halves(spark, sf_dir):
    """Rows loaded earlier and the next batch; the batch starts again inside the loaded period."""
    rows = before(spark, sf_dir).filter(HAS_STATION)
    return rows.filter(OLD), rows.filter(NEW).withColumn("capacity", F.col("capacity") + F.dayofmonth("collected_at"))


OLD_SQL = f"SELECT * FROM before_ WHERE {HAS_STATION} AND {OLD}"
NEW_SQL = f"SELECT * REPLACE (capacity + extract(day FROM collected_at) AS capacity) FROM before_ WHERE {HAS_STATION} AND {NEW}"
HALVES = [("old", OLD_SQL), ("new", NEW_SQL)]
TOWN_TAIL = "left(town_code, 2) AS dept_code, CAST(NULL AS INTEGER) AS population, CAST(NULL AS DECIMAL(10,2)) AS area_ha"


@register("l1_insert_towns", sql(f"SELECT DISTINCT town_code, town_name, {TOWN_TAIL} FROM (SELECT * FROM old UNION ALL SELECT * FROM new)", "before_", extra=HALVES))
def l1(spark, sf_dir):
    old, new = halves(spark, sf_dir)
    return load.insert_absent(load.towns_of(old), load.towns_of(new), "town_code", ["town_name"])


LAST = "QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY collected_at DESC, row_id DESC) = 1"


@register("l2_upsert_stations", sql(f"""SELECT station_id, first(station_code ORDER BY part) AS station_code, {', '.join(f"arg_max({c}, (collected_at, part, row_id)) AS {c}" for c in ("station_name", "latitude", "longitude", "capacity", "town_code"))}
 FROM (SELECT 0 AS part, * FROM (SELECT * FROM old {LAST}) UNION ALL SELECT 1, * FROM (SELECT * FROM new {LAST})) GROUP BY station_id""", "before_", extra=HALVES))
def l2(spark, sf_dir):
    """Newer rows replace the attributes of known stations; a late batch changes nothing."""
    old, new = halves(spark, sf_dir)
    existing = latest_by(old.select(*load.STATION_COLUMNS, "collected_at", "row_id"), ["station_id"], ["collected_at", "row_id"])
    stored = existing.select(*load.STATION_COLUMNS, F.col("collected_at").alias("seen_at"))
    return load.upsert_latest(stored, new, "station_id", ["collected_at", "row_id"],
                              ["station_name", "latitude", "longitude", "capacity", "town_code"]).drop("seen_at")


INSERTED = """SELECT * FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.station_id = n.station_id AND o.collected_at = n.collected_at)
 QUALIFY row_number() OVER (PARTITION BY station_id, collected_at ORDER BY row_id) = 1"""


@register("l3_insert_new", sql("SELECT row_id, station_id, collected_at, docks_free FROM ins", "before_", extra=HALVES + [("ins", INSERTED)]))
def l3(spark, sf_dir):
    old, new = halves(spark, sf_dir)
    return load.insert_new_readings(old.select("station_id", "collected_at"), new).select("row_id", "station_id", "collected_at", "docks_free")


@register("l4_insert_children", sql(f"""SELECT {READING_ID} AS reading_id, 1 AS bike_type_id, bikes_mechanical AS bikes FROM ins
 UNION ALL SELECT {READING_ID}, 2, bikes_electric FROM ins""", "before_", extra=HALVES + [("ins", INSERTED)]))
def l4(spark, sf_dir):
    old, new = halves(spark, sf_dir)
    inserted = load.with_reading_id(load.insert_new_readings(old.select("station_id", "collected_at"), new))
    return load.insert_children(inserted, load.seed_types(spark))


FINE = "SELECT row_id, station_id * (1 - 2 * (row_id % 2)) AS station_id, collected_at + to_microseconds(row_id % 1000000) AS collected_at FROM readings"


@register("l6_reading_ids", sql(f"SELECT row_id, {READING_ID} AS reading_id FROM fine", "readings", extra=[("fine", FINE)]))
def l6(spark, sf_dir):
    """Ids of any BIGINT station, negative ones too, and of times with a fraction of a second."""
    sign = 1 - 2 * (F.col("row_id") % 2)
    fine = F.col("collected_at") + F.make_dt_interval(secs=((F.col("row_id") % 1000000) / 1000000).cast("decimal(18,6)"))
    rows = readings(spark, sf_dir).select("row_id", (F.col("station_id") * sign).alias("station_id"), fine.alias("collected_at"))
    return load.with_reading_id(rows).select("row_id", "reading_id")


# the limits of the target schema, written out: table, rule, condition of a violating row
ROW_LIMITS = """
town|not null town_code|town_code IS NULL
town|not null town_name|town_name IS NULL
town|not null dept_code|dept_code IS NULL
town|length town_code|length(rtrim(town_code)) > 5
town|length dept_code|length(rtrim(dept_code)) > 2
town|length town_name|length(rtrim(town_name)) > 100
town|check population >= 0|population < 0
town|check area_ha > 0|area_ha <= 0
station|not null station_id|station_id IS NULL
station|not null station_code|station_code IS NULL
station|not null station_name|station_name IS NULL
station|not null latitude|latitude IS NULL
station|not null longitude|longitude IS NULL
station|not null capacity|capacity IS NULL
station|not null town_code|town_code IS NULL
station|length town_code|length(rtrim(town_code)) > 5
station|length station_code|length(rtrim(station_code)) > 10
station|length station_name|length(rtrim(station_name)) > 150
station|check latitude range|abs(latitude) > 90
station|check longitude range|abs(longitude) > 180
station|check capacity > 0|capacity <= 0
station|smallint capacity|capacity > 32767 OR capacity < -32768
bike_type|not null bike_type_id|bike_type_id IS NULL
bike_type|not null type_code|type_code IS NULL
bike_type|not null type_label|type_label IS NULL
bike_type|length type_code|length(rtrim(type_code)) > 20
bike_type|length type_label|length(rtrim(type_label)) > 50
reading|not null reading_id|reading_id IS NULL
reading|not null station_id|station_id IS NULL
reading|not null collected_at|collected_at IS NULL
reading|not null updated_at|updated_at IS NULL
reading|not null docks_free|docks_free IS NULL
reading|not null is_installed|is_installed IS NULL
reading|not null is_renting|is_renting IS NULL
reading|not null is_returning|is_returning IS NULL
reading|check docks_free >= 0|docks_free < 0
reading|smallint docks_free|docks_free > 32767 OR docks_free < -32768
reading_bikes|not null reading_id|reading_id IS NULL
reading_bikes|not null bike_type_id|bike_type_id IS NULL
reading_bikes|not null bikes|bikes IS NULL
reading_bikes|check bikes >= 0|bikes < 0
reading_bikes|smallint bikes|bikes > 32767 OR bikes < -32768
"""
# table, rule, columns: rows beyond the first of a complete key
KEY_LIMITS = """
town|primary key town_code|town_code
station|primary key station_id|station_id
station|unique station_code|station_code
bike_type|primary key bike_type_id|bike_type_id
bike_type|unique type_code|type_code
reading|primary key reading_id|reading_id
reading|unique station_id, collected_at|station_id, collected_at
reading_bikes|primary key reading_id, bike_type_id|reading_id, bike_type_id
"""
# table, column, parent: rows whose value has no parent row
PARENTS = """
station|town_code|town
reading|station_id|station
reading_bikes|reading_id|reading
reading_bikes|bike_type_id|bike_type
"""


def _lines(text):
    return [line.split("|") for line in text.strip().splitlines()]


def violation_sql():
    """Violations per rule of the tables ``t_<name>``."""
    parts = [f"SELECT '{t}' AS table_name, '{rule}' AS rule, count_if({bad})::BIGINT AS violations FROM t_{t}" for t, rule, bad in _lines(ROW_LIMITS)]
    for t, rule, columns in _lines(KEY_LIMITS):
        complete = " AND ".join(f"{c.strip()} IS NOT NULL" for c in columns.split(","))
        parts.append(f"SELECT '{t}', '{rule}', coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM t_{t} WHERE {complete} GROUP BY {columns})")
    for t, column, parent in _lines(PARENTS):
        parts.append(f"SELECT '{t}', 'foreign key {column}', count(*) FROM t_{t} c ANTI JOIN t_{parent} p ON p.{column} = c.{column} WHERE c.{column} IS NOT NULL")
    return union_all(parts)


# breaches of every kind of rule, valid in both engines
BREACHES = {
    "station_name": "CASE WHEN station_id % 13 = 1 THEN repeat('n', 151) ELSE station_name END",
    "station_code": "CASE WHEN station_id % 17 = 2 THEN repeat('c', 11) ELSE station_code END",
    "town_name": "CASE WHEN station_id % 19 = 3 THEN repeat('t', 101) ELSE town_name END",
    "town_code": "CASE WHEN station_id % 47 = 7 THEN '7500000' ELSE town_code END",
    "capacity": "CASE WHEN station_id % 23 = 4 THEN 40000 ELSE capacity END",
    "latitude": "CASE WHEN station_id % 29 = 5 THEN CAST(95.0 AS DOUBLE) ELSE latitude END",
    "longitude": "CASE WHEN station_id % 29 = 6 THEN CAST(200.0 AS DOUBLE) ELSE longitude END",
    "docks_free": "CASE row_id % 31 WHEN 1 THEN 40000 WHEN 2 THEN -5 WHEN 3 THEN NULL ELSE docks_free END",
    "bikes_mechanical": "CASE row_id % 37 WHEN 1 THEN 40000 WHEN 2 THEN -1 ELSE bikes_mechanical END",
    "updated_at": "CASE WHEN row_id % 41 = 1 THEN NULL ELSE updated_at END",
    "is_installed": "CASE WHEN row_id % 43 = 1 THEN NULL ELSE is_installed END",
    "is_renting": "CASE WHEN row_id % 43 = 2 THEN NULL ELSE is_renting END",
    "is_returning": "CASE WHEN row_id % 43 = 3 THEN NULL ELSE is_returning END",
}
NO_STATION, NO_TOWN, NO_READING, ODD_TYPE = "station_id % 11 <> 3", "town_code <> '75004'", "row_id % 53 <> 5", "row_id % 59 = 1"
TOWN_FIGURES = {"population": "CAST(CASE WHEN town_code = '75001' THEN -1 ELSE population END AS INT)",
                "area_ha": "CAST(CASE WHEN town_code = '75002' THEN 0 ELSE area_ha END AS DECIMAL(10,2))"}
WRONG_TYPES = [(1, "mechanical", "Mechanical bike"), (2, "ebike", "Electric bike"), (2, "ebike", None), (None, "a code of more than twenty characters", "x" * 51)]
BREACHED = [
    ("breached", replaced_sql(BREACHES, "before_")),
    ("t_town", replaced_sql(TOWN_FIGURES, f"(SELECT DISTINCT town_code, town_name, {TOWN_TAIL} FROM breached) WHERE town_code IS NULL OR {NO_TOWN}")),
    ("t_station", f"SELECT {STATION} FROM breached WHERE {NO_STATION} {LAST}"),
    ("t_bike_type", "SELECT * FROM (VALUES (1, 'mechanical', 'Mechanical bike'), (2, 'ebike', 'Electric bike'), (2, 'ebike', NULL), "
                    "(NULL, 'a code of more than twenty characters', repeat('x', 51))) AS t(bike_type_id, type_code, type_label)"),
    ("t_reading", f"SELECT {READING_ID} AS reading_id, * FROM breached WHERE {NO_READING}"),
    ("t_reading_bikes", f"""SELECT {READING_ID} AS reading_id, 1 AS bike_type_id, bikes_mechanical AS bikes FROM breached UNION ALL
 SELECT {READING_ID}, 2, bikes_electric FROM breached UNION ALL SELECT {READING_ID}, 3, 0 FROM breached WHERE {ODD_TYPE}"""),
]


def breached(spark, sf_dir):
    """Rows that break rules of every kind, taken as target tables."""
    rows = load.with_reading_id(replaced(before(spark, sf_dir, stored=True), BREACHES))
    types = load.seed_types(spark)
    last = latest_by(rows.filter(NO_STATION), ["station_id"], ["collected_at", "row_id"])
    children = load.insert_children(rows, types).unionByName(
        rows.filter(ODD_TYPE).select("reading_id", F.lit(3).alias("bike_type_id"), F.lit(0).cast("bigint").alias("bikes")))
    return {
        "town": replaced(load.towns_of(rows).filter(f"town_code IS NULL OR {NO_TOWN}"), TOWN_FIGURES), "station": last.select(*load.STATION_COLUMNS),
        "bike_type": spark.createDataFrame(WRONG_TYPES, "bike_type_id int, type_code string, type_label string"),
        "reading": rows.filter(NO_READING).select(*load.READING_COLUMNS), "reading_bikes": children,
    }


@register("l7_violations", sql(violation_sql(), "before_", extra=BREACHED))
def l7(spark, sf_dir):
    return constraints.validate(breached(spark, sf_dir))


@register("l7_violations_once", sql(violation_sql(), "before_", extra=BREACHED))
def l7_once(spark, sf_dir):
    """The same findings from one scan per table and one exchange."""
    return constraints.validate_once(breached(spark, sf_dir))


NO_VIOLATION = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{rule}' AS rule, 0::BIGINT AS violations" for t, rule, _ in [
    *_lines(ROW_LIMITS), *_lines(KEY_LIMITS), *((t, f"foreign key {c}", p) for t, c, p in _lines(PARENTS))])


@register("l7_target_valid", NO_VIOLATION)
def l7b(spark, sf_dir):
    """The repaired tables break no rule."""
    return constraints.validate(target(spark, sf_dir))


@register("l8_station_dim", sql(f"SELECT {STATION}, town_name FROM station_dim", "station_dim"))
def l8(spark, sf_dir):
    valid = C.r4_valid_versions(versions(spark, sf_dir), MIN_NAMED)
    return load.build_station_dim(valid, readings(spark, sf_dir).select("station_id", "station_code"))


@register("l9_town_dim", sql(f"SELECT DISTINCT town_code, town_name, {TOWN_TAIL} FROM station_dim", "station_dim"))
def l9(spark, sf_dir):
    return load.build_town_dim(l8(spark, sf_dir))


READING = ", ".join(load.READING_COLUMNS)


@register("l10_readings", sql(f"SELECT {READING} FROM reading_", "reading_"))
def l10(spark, sf_dir):
    return target(spark, sf_dir)["reading"]


CHILDREN = "SELECT reading_id, 1 AS bike_type_id, bikes_mechanical AS bikes FROM reading_ UNION ALL SELECT reading_id, 2, bikes_electric FROM reading_"


@register("l10_reading_bikes", sql(CHILDREN, "reading_"))
def l10b(spark, sf_dir):
    return target(spark, sf_dir)["reading_bikes"]


@register("l11_cascade", sql("""SELECT 'station' AS table_name, count(*) AS n_rows FROM station_dim WHERE town_code <> '75007' UNION ALL
 SELECT 'reading', count(*) FROM reading_ WHERE station_id NOT IN (SELECT station_id FROM station_dim WHERE town_code = '75007') UNION ALL
 SELECT 'reading_bikes', 2 * count(*) FROM reading_ WHERE station_id NOT IN (SELECT station_id FROM station_dim WHERE town_code = '75007')""", "reading_", "station_dim"))
def l11(spark, sf_dir):
    from dockwatch.operators.aggregates import table_counts

    tables = target(spark, sf_dir)
    gone = tables["station"].filter(F.col("town_code") == "75007").select("station_id")
    left = load.cascade_delete(tables, gone)
    return table_counts({n: left[n] for n in ("station", "reading", "reading_bikes")})


FLAT = """SELECT reading_id, collected_at, updated_at, station_id, station_code, station_name, latitude, longitude, capacity, town_code, town_name,
 bikes_total, bikes_mechanical, bikes_electric, docks_free, is_installed FROM after_"""


@register("l15_flat_view", sql(FLAT, "after_"))
def l15(spark, sf_dir):
    return load.flat_view(target(spark, sf_dir))


@register("j8_star_join", sql(FLAT, "after_"))
def j8(spark, sf_dir):
    return L.read_back(target(spark, sf_dir))


@register("j17_lateral_types", sql("SELECT row_id, collected_at, 'mechanical' AS type_code, bikes_mechanical AS bikes FROM clean_ UNION ALL SELECT row_id, collected_at, 'ebike', bikes_electric FROM clean_", "clean_"))
def j17(spark, sf_dir):
    return unpivot_types(repaired(spark, sf_dir)[1], ["row_id", "collected_at"])
