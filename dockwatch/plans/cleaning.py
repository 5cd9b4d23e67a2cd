"""Ordered repair of the readings, with a journal of the rows each rule touched.

A step function that is called without its lookup stores its input first, so that no step computes the earlier ones again.

The rules are written as flags on one frame instead of successive deletes: the frame is stored
once and the journal, the clean rows and the station dimension are all read from it.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from dockwatch import schemas as S
from dockwatch.operators.aggregates import majority_groups
from dockwatch.operators.asof import asof_version, attach_reference
from dockwatch.operators.ordering import keep_lowest, repeated_keys, surplus_rows, with_neighbours
from dockwatch.operators.relations import update_from
from dockwatch.plans.audit import late_update, over_capacity
from dockwatch.plans.readings import silent, silent_sql
from dockwatch.session import fixed_rows, materialise
from dockwatch.sources.reference import type_reference, valid_versions

WORKING_COLUMNS = [
    "row_id", "station_id", "station_code", "collected_at", "updated_at", "bikes_total", "bikes_mechanical",
    "bikes_electric", "docks_free", "is_installed", "is_renting", "is_returning",
]

# order, rule, check, action
JOURNAL = [
    (1, "R1 collection time moved to the last update received", "V6", "correction"),
    (2, "R2 station code taken from the station id", "C1", "substitution"),
    (3, "R3 split imputed from the neighbouring reading", "C2", "imputation"),
    (3, "R3 split impossible to impute", "C2", "deletion"),
    (4, "R4 reference rows of blank versions dropped", "C3", "deletion"),
    (4, "R4 station attributes taken from the last valid version", "C3", "substitution"),
    (5, "R5 station names without extra spaces", "V5", "correction"),
    (6, "R6 readings of stations with capacity 0", "V1", "deletion"),
    (7, "R7 readings of stations silent for more than 24 h", "K3", "deletion"),
    (8, "R8 readings that cannot be attached", "I2", "deletion"),
    (9, "R9 duplicate station / collection", "U1", "deletion"),
    (10, "K2 bikes + docks above capacity", "K2", "none"),
]
JOURNAL_FLAGS = ["r1", "r2", "r3a", "r3b", None, "r4b", "r5", "r6", "r7", "r8", None, None]


@dataclass
class Repair:
    """Result of a repair run."""

    flagged: DataFrame  # every reading with its repaired values and rule flags
    clean: DataFrame    # surviving readings
    valid_reference: DataFrame
    reference: DataFrame


def r0_working_set(before: DataFrame) -> DataFrame:
    """Feed columns only; the reference attributes are joined again by R4."""
    kept = [c for c in WORKING_COLUMNS if c in before.columns]
    out = before.select(*kept, F.col("station_name").isNull().alias("had_no_name"))
    return out.withColumn("r1", F.lit(False)).withColumn("r2", F.lit(False)).withColumn("r3a", F.lit(False))


def late_collections(df: DataFrame, tolerance=S.CLOCK_TOLERANCE_MINUTES) -> DataFrame:
    """Collections of which more than half the readings were updated after them, and their true time."""
    late = majority_groups(df, "collected_at", late_update(tolerance), F.max("updated_at").alias("moved_to"))
    return late.select("collected_at", "moved_to")


def r1_clock(df: DataFrame, late: DataFrame = None) -> DataFrame:
    """Move each late collection, as a whole, to its last station update."""
    if late is None:
        df = materialise(df, "r0")
        late = late_collections(df)
    joined = df.join(late, "collected_at", "left")
    moved = F.col("moved_to").isNotNull()
    return joined.withColumn("collected_at", F.coalesce("moved_to", "collected_at")).withColumn("r1", moved).drop("moved_to")


def known_codes(df: DataFrame) -> DataFrame:
    """One station code per station id."""
    coded = df.filter(F.col("station_code").isNotNull() & F.col("station_id").isNotNull())
    return coded.groupBy("station_id").agg(F.max("station_code").alias("station_code"))


def r2_code(df: DataFrame, codes: DataFrame = None) -> DataFrame:
    """Give readings without a code the code known for their station id.

    Only the readings that lack one are joined; the others pass by without a shuffle.
    """
    if codes is None:
        df = materialise(df, "r1")
        codes = materialise(known_codes(df), "codes")
    missing = F.col("station_code").isNull()
    filled = update_from(df.filter(missing), codes, "station_id", ["station_code"])
    filled = filled.withColumn("r2", F.col("station_code").isNotNull())
    return df.filter(~missing).unionByName(filled)


def r3_impute(df: DataFrame, neighbours: DataFrame = None) -> DataFrame:
    """Split the total where the electric count is missing, using the previous (else next) reading.

    Only the readings to impute are joined with their neighbours.
    """
    if neighbours is None:
        df = materialise(df, "r2")
        neighbours = materialise(with_neighbours(df, "bikes_electric", only_missing=True), "donors")
    donors = neighbours.select("row_id", F.coalesce("previous_value", "next_value").alias("donor"))
    missing = F.col("bikes_electric").isNull()
    # an unknown total leaves the neighbour's count as it is (least ignores NULL)
    electric = F.least("donor", "bikes_total")
    has_donor = F.col("donor").isNotNull()
    joined = df.filter(missing).join(donors, "row_id", "left").select(
        *[c for c in df.columns if c not in ("bikes_electric", "bikes_mechanical", "r3a")],
        F.when(has_donor, electric).otherwise(F.col("bikes_electric")).alias("bikes_electric"),
        F.when(has_donor, F.col("bikes_total") - electric).otherwise(F.col("bikes_mechanical")).alias("bikes_mechanical"),
        has_donor.alias("r3a"),
    )
    return df.filter(~missing).unionByName(joined)


NO_SPLIT = "(bikes_electric IS NULL OR bikes_mechanical IS NULL)"


def r3_drop(df: DataFrame) -> DataFrame:
    """Drop readings of which either count is still missing."""
    return df.filter(f"NOT {NO_SPLIT}")


def r4_valid_versions(reference: DataFrame, min_named: int = S.MIN_NAMED_ROWS, accepted: DataFrame = None) -> DataFrame:
    """Typed rows of the complete versions only, names already repaired (R5).

    ``accepted`` is the list of complete versions when it is stored already.
    """
    accepted = valid_versions(reference, min_named) if accepted is None else accepted
    return type_reference(reference.join(accepted, "version_ts", "left_semi"), squash_names=True)


def r4_dropped_rows(reference: DataFrame, min_named: int = S.MIN_NAMED_ROWS) -> DataFrame:
    """Rows of the versions that were set aside."""
    per_version = reference.groupBy("version_ts").agg(F.count("station_name").alias("named"), F.count(F.lit(1)).alias("n"))
    return per_version.filter(F.col("named") < min_named).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))


def r4_rejoin(df: DataFrame, valid: DataFrame, picks: DataFrame = None) -> DataFrame:
    """Attach the last valid version at or before each collection, the first one if there is none."""
    picks = asof_version(df, valid, fallback=True) if picks is None else picks
    return attach_reference(df, valid, picks)


def _true(condition):
    return F.coalesce(condition, F.lit(False))


def flag_rows(df: DataFrame) -> DataFrame:
    """Rule flags R3b to R8; each deletion only counts rows the earlier ones left."""
    unattached = "station_id IS NULL OR station_code IS NULL OR town_code IS NULL OR station_name IS NULL"
    # the first deletion rule that applies
    deleted_by = f"""CASE WHEN {NO_SPLIT} THEN 'r3b' WHEN capacity <= 0 THEN 'r6' WHEN {silent_sql(S.SILENT_HOURS)} THEN 'r7'
        WHEN {unattached} THEN 'r8' ELSE 'kept' END"""
    marked = df.withColumn("fate", F.expr(deleted_by))
    return marked.selectExpr(
        *[c for c in df.columns], *[f"fate = '{f}' AS {f}" for f in ("r3b", "r6", "r7", "r8", "kept")],
        "fate <> 'r3b' AND had_no_name AND station_name IS NOT NULL AS r4b",
        "fate <> 'r3b' AND coalesce(name_fixed, false) AS r5",
    )


def r6_capacity(df: DataFrame) -> DataFrame:
    """Drop readings of stations with no capacity; an unknown capacity stays."""
    return df.filter(~_true(F.col("capacity") <= 0))


def r7_silent(df: DataFrame, hours: int = S.SILENT_HOURS) -> DataFrame:
    return df.filter(~_true(silent(hours)))


def r8_unattached(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["station_id", "station_code", "town_code", "station_name"])


def r9_dedup(df: DataFrame) -> DataFrame:
    return keep_lowest(df, ["station_id", "collected_at"])


def r10_kept(df: DataFrame) -> DataFrame:
    """Readings over capacity: the operator's information is kept."""
    return df.filter(_true(over_capacity()))


def collection_lookup(work: DataFrame, valid: DataFrame) -> DataFrame:
    """R1 and the version choice of R4 for each collection: true time, moved or not, version in force."""
    times = r1_clock(work.select("collected_at").distinct().withColumn("given", F.col("collected_at")), late_collections(work))
    picks = asof_version(times, valid, fallback=True)
    return times.join(picks, "collected_at").select(
        F.col("given").alias("collected_at"), F.col("collected_at").alias("true_time"), F.col("r1").alias("moved"), "version_ts")


def repair(before: DataFrame, reference: DataFrame, min_named: int = S.MIN_NAMED_ROWS) -> Repair:
    """Run R0 to R9. ``before`` should be a stored table: it is read once per lookup and once per rule branch.

    Lookups (collections, codes, neighbours, valid versions) are stored first. Their true size is
    then known, so the planner broadcasts a small one and shuffles a large one.
    """
    work = r0_working_set(before)
    accepted = materialise(valid_versions(reference, min_named), "accepted")
    valid = materialise(r4_valid_versions(reference, min_named, accepted), "valid")
    collections = materialise(collection_lookup(work, valid), "collections")
    codes = materialise(known_codes(before), "codes")
    work = work.join(collections, "collected_at").withColumns({"collected_at": F.col("true_time"), "r1": F.col("moved")})
    work = work.drop("true_time", "moved")
    donors = materialise(with_neighbours(work, "bikes_electric", only_missing=True), "donors")
    work = r3_impute(r2_code(work, codes), donors)
    flagged = materialise(flag_rows(attach_reference(work, valid)), "flagged")
    # R9: duplicates are few, so their row ids are listed and taken out; whole rows are not shuffled
    kept, keys = flagged.filter("kept"), ["station_id", "collected_at"]
    repeated = materialise(repeated_keys(kept, keys), "repeated")
    surplus = materialise(surplus_rows(kept, repeated, keys), "surplus")
    clean = kept.join(surplus, "row_id", "left_anti").drop(
        "had_no_name", "name_fixed", "kept", "version_ts", *[f for f in JOURNAL_FLAGS if f and f not in ("r1", "r3a")]
    )
    clean = clean.withColumnsRenamed({"r1": "time_corrected", "r3a": "split_imputed"})
    return Repair(flagged, clean, valid, reference)


def journal_labels(spark) -> DataFrame:
    rows = [(i, *entry) for i, entry in enumerate(JOURNAL)]
    return fixed_rows(spark, rows, {"line": "int", "step": "long", "rule": "string", "check_id": "string", "action": "string"})


def journal(result: Repair, clean: DataFrame, min_named: int = S.MIN_NAMED_ROWS) -> DataFrame:
    """Rows touched by each rule, in rule order; one pass over the flagged rows and one over the clean ones."""

    def lines(counted, **numbered):
        pairs = ", ".join(f"{i}, CAST({c} AS BIGINT)" for c, i in numbered.items())
        return counted.selectExpr(f"stack({len(numbered)}, {pairs}) AS (line, n)")

    flags = {f: i for i, f in enumerate(JOURNAL_FLAGS) if f}
    touched = result.flagged.agg(*[F.count_if(F.col(f)).alias(f) for f in flags], F.count_if("kept").alias("kept"))
    after = clean.agg((-F.count(F.lit(1))).alias("final"), F.count_if(_true(over_capacity())).alias("over"))
    dropped = r4_dropped_rows(result.reference, min_named)
    # duplicates (line 10) = rows kept by the rules - rows left in the end
    counts = (
        lines(touched, **flags, kept=10).unionByName(lines(after, final=10, over=11)).unionByName(lines(dropped, n=4))
        .groupBy("line").agg(F.sum("n").alias("n_rows"))
    )
    labels = journal_labels(clean.sparkSession)
    return counts.join(labels, "line").select(
        "step", "rule", "check_id", "action", "n_rows").orderBy("step", "rule")
