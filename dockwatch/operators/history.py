"""Change history of the reference: intervals instead of whole versions, and the as-of join on them.

Every version of the reference lists every station, though little changes between two downloads. A history holds a row per run of
versions in a row in which a code has the same attributes: ``valid_from`` is the first of them, ``valid_to`` the first version
after the run (NULL: still valid). A version that does not list a code, a blank one for example, ends its interval, so
the join gives what the version in force would give, NULLs included. A line that a version holds twice counts once.
"""

from pyspark.sql import DataFrame, Window, functions as F

from dockwatch.operators.asof import asof_version

KEYS = ["station_code", "valid_from", "valid_to"]


def _attributes(reference: DataFrame) -> list:
    return [c for c in reference.columns if c not in ("station_code", "version_ts", "version_file", "line")]


def build_history(reference: DataFrame) -> DataFrame:
    """Intervals of all versions of ``reference`` (``station_code, version_ts`` and attributes).

    Windows see one row per version, or the versions of one code with one set of attributes.
    """
    attributes = _attributes(reference)
    versions = reference.select("version_ts").filter(F.col("version_ts").isNotNull()).distinct()
    in_time = Window.orderBy("version_ts")  # one row per version
    versions = versions.select("version_ts", F.row_number().over(in_time).alias("no"), F.lead("version_ts").over(in_time).alias("next_ts"))
    lines = reference.filter(F.col("station_code").isNotNull()).select("version_ts", "station_code", *attributes).distinct().join(versions, "version_ts")
    same = Window.partitionBy("station_code", *attributes).orderBy("no")
    # numbers in a row minus their position are equal
    runs = lines.withColumn("run", F.col("no") - F.row_number().over(same)).groupBy("station_code", *attributes, "run")
    return runs.agg(F.min("version_ts").alias("valid_from"), F.max_by("next_ts", "no").alias("valid_to")).select(*KEYS, *attributes)


def append_version(history: DataFrame, rows: DataFrame, version_ts, min_named: int = None) -> DataFrame:
    """History after one more version, later than all before; only its open intervals meet the new rows.

    With ``min_named`` a version with fewer named rows is passed over (T9); else a blank version ends every interval.
    """
    stamp = F.lit(version_ts).cast(history.schema["valid_from"].dataType)
    known = history.agg(F.greatest(F.max("valid_from"), F.max("valid_to")).alias("t")).filter(F.col("t") >= stamp)
    if not known.isEmpty():
        raise ValueError(f"version {version_ts} is not later than the history; build it again")
    if min_named is not None and rows.filter(F.col("station_name").isNotNull()).count() < min_named:
        return history
    attributes = [c for c in history.columns if c not in KEYS]
    is_open = F.col("valid_to").isNull()
    held = history.filter(is_open).withColumns({"old": F.lit(True), "new": F.lit(False)}).drop("valid_to")
    came = rows.filter(F.col("station_code").isNotNull()).select("station_code", *attributes).distinct()
    came = came.withColumns({"valid_from": F.lit(None).cast(history.schema["valid_from"].dataType), "old": F.lit(False), "new": F.lit(True)})
    both = held.unionByName(came).groupBy("station_code", *attributes).agg(F.max("old").alias("old"), F.max("new").alias("new"), F.min("valid_from").alias("valid_from"))
    now = both.select("station_code", F.coalesce("valid_from", stamp).alias("valid_from"), F.when(~F.col("new"), stamp).alias("valid_to"), *attributes)
    return history.filter(~is_open).unionByName(now)


def attach_history(readings: DataFrame, history: DataFrame, picks: DataFrame = None) -> DataFrame:
    """Left join of the attributes in force at the reading's version; the same rows as ``attach_reference`` gives.

    ``picks`` (collection time -> version) is joined first when given. Intervals are listed once per month they touch, and
    readings meet those of their code and month only, so a code with a long history stays cheap. A reading without code or version meets
    nothing and gets a key of its own.
    """
    if picks is not None:
        readings = readings.join(picks, "collected_at")
    month = lambda c: F.date_trunc("month", c).cast("date")
    own_key = F.concat(F.lit("\u0000"), F.col("row_id").cast("string"))
    lost = F.col("version_ts").isNull() | F.col("station_code").isNull()
    keyed = readings.withColumns({"join_code": F.when(lost, own_key).otherwise(F.col("station_code")), "join_month": month(F.col("version_ts"))})
    newest = history.agg(F.greatest(F.max("valid_from"), F.max("valid_to"))).scalar()
    months = F.sequence(month(F.col("valid_from")), month(F.coalesce("valid_to", newest)), F.expr("INTERVAL 1 MONTH"))
    listed = history.withColumnRenamed("station_code", "known_code").withColumn("known_month", F.explode(months))
    meets = (F.col("join_code") == F.col("known_code")) & (F.col("join_month") == F.col("known_month")) & (
        F.col("version_ts") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("version_ts") < F.col("valid_to")))
    return keyed.join(listed, meets, "left").drop("join_code", "join_month", "known_code", "known_month", "valid_from", "valid_to")


def attach_at_collection(readings: DataFrame, history: DataFrame, versions: DataFrame, fallback: bool = False) -> DataFrame:
    """As-of join by collection time: the version in force then (``versions``: all version times), its attributes from the history.

    With ``fallback`` a reading before the first version takes the first one.
    """
    return attach_history(readings, history, asof_version(readings, versions, fallback=fallback))


def history_changes(history: DataFrame, attributes=("station_name", "capacity", "town_code")) -> DataFrame:
    """Codes whose attributes differ from those they had before: code, version, old and new attributes.

    Of lines with the same code and version the greatest counts. The window sees the intervals of one code.
    """
    single = history.groupBy("station_code", F.col("valid_from").alias("version_ts")).agg(F.max(F.struct(*attributes)).alias("now"))
    compared = single.withColumn("was", F.lag("now").over(Window.partitionBy("station_code").orderBy("version_ts")))
    return compared.filter(F.col("was").isNotNull() & ~F.col("now").eqNullSafe(F.col("was"))).select(
        "station_code", "version_ts",
        *[F.col(f"was.{a}").alias(f"{a}_before") for a in attributes], *[F.col(f"now.{a}").alias(f"{a}_after") for a in attributes])
