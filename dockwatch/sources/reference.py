"""Versions of the station reference file: read them all, pick the newest, judge their validity."""

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from dockwatch import schemas as S
from dockwatch.functions import text as X
from dockwatch.sources.lake import FILE_KEY, _children


def read_reference_versions(spark: SparkSession, path) -> DataFrame:
    """Every row of every version, all text, with the full path, download time and line position of its rows.

    The day folder and the HHMMSS of the file give the download time (UTC). A version is its full path, not its base name: two days may hold the same HHMMSS.
    """
    # the header is compared by name: a file with other columns, or in another order, fails instead of shifting values
    raw = spark.read.schema(S.REFERENCE_CSV_SCHEMA).csv(path, sep=";", header=True, enforceSchema=False)
    file_path = F.col("_metadata.file_path")
    stamp = F.concat_ws(" ", F.regexp_extract(file_path, FILE_KEY, 1), F.regexp_extract(file_path, FILE_KEY, 2))
    return raw.select(
        *[X.blank_to_null(f).alias(c) for f, c in S.REFERENCE_CSV.items()],
        file_path.alias("version_file"),
        # rows of one split are numbered in file order, and splits by their place in the file
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("line"),
        F.try_to_timestamp(F.concat(stamp, F.lit("+00")), F.lit("yyyy-MM-dd HHmmssx")).alias("version_ts"),
    )


def read_newest_version(spark: SparkSession, path: str, min_named: int = None) -> DataFrame:
    """Rows of the newest version only, found by file name: older files are not opened.

    Days are tried from the newest on, and only the files of a tried day are listed. With ``min_named`` a blank
    newest file is passed over for the newest valid one. None when there is no such version yet.
    """
    for day in sorted((d for d in _children(spark, path) if d.startswith("date=")), reverse=True):
        by_key = {}
        for name in files_below(spark, f"{path}/{day}"):
            found = re.search(FILE_KEY, name)
            if found:
                by_key.setdefault(found.groups(), []).append(name)
        for key in sorted(by_key, reverse=True):
            rows = read_reference_versions(spark, by_key[key])
            if min_named is None or rows.filter(F.col("station_name").isNotNull()).count() >= min_named:
                return one_row_per_code(rows)
    return None


def files_below(spark: SparkSession, path: str) -> list:
    """Full names of the data files in a folder and its subfolders."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, out = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True), []
    while found.hasNext():
        file = found.next().getPath()
        if not file.getName().startswith(("_", ".")):
            out.append(file.toString())
    return out


def unplaced_files(spark: SparkSession, path: str) -> list:
    """Reference files whose name gives no download time; they belong to no version."""
    return [name for name in files_below(spark, path) if not re.search(FILE_KEY, name)]


def one_row_per_code(rows: DataFrame) -> DataFrame:
    """A code listed twice keeps its last line; rows that carry no line position keep a fixed row (greatest name)."""
    coded = rows.filter(F.col("station_code").isNotNull())
    others = [c for c in rows.columns if c not in ("station_code", "line")]
    values = F.struct("station_name", *[c for c in others if c != "station_name"])
    best = coded.groupBy("station_code").agg(
        (F.max_by(values, F.struct("version_file", "line")) if "line" in rows.columns else F.max(values)).alias("r"))
    return best.select("station_code", *[F.col(f"r.{c}").alias(c) for c in others])


def valid_versions(reference: DataFrame, min_named: int = S.MIN_NAMED_ROWS) -> DataFrame:
    """Version times with at least ``min_named`` named rows."""
    return (
        reference.groupBy("version_ts").agg(F.count("station_name").alias("named"))
        .filter(F.col("named") >= min_named).select("version_ts")
    )


def newest_version(reference: DataFrame, min_named: int = None) -> DataFrame:
    """Rows of the newest version, one row per station code; empty when there is no version yet."""
    candidates = reference if min_named is None else keep_groups(reference, ["version_ts"], "station_name", min_named)
    newest = candidates.agg(F.max("version_ts").alias("version_ts"))
    return one_row_per_code(candidates.join(newest, "version_ts", "left_semi"))


def keep_groups(df: DataFrame, keys, counted: str, min_rows: int) -> DataFrame:
    """Rows of the groups that hold at least ``min_rows`` non-null values of ``counted``."""
    qualified = df.groupBy(*keys).agg(F.count(counted).alias("n")).filter(F.col("n") >= min_rows).select(*keys)
    return df.join(qualified, keys, "left_semi")


def reference_size(reference: DataFrame) -> DataFrame:
    """Number of rows in the newest version."""
    per_version = reference.groupBy("version_ts").agg(F.count(F.lit(1)).alias("stations"))
    return per_version.agg(F.max_by("stations", "version_ts").alias("stations"), F.max("version_ts").alias("version_ts"))


def type_reference(reference: DataFrame, squash_names: bool = False) -> DataFrame:
    """Typed reference rows; with ``squash_names`` names are repaired and flagged."""
    lat, lon = X.split_coords("coordinates")
    name = X.squash_ws("station_name") if squash_names else F.col("station_name")
    strip = F.trim if squash_names else (lambda c: c)
    out = reference.select(
        "version_ts", "station_code", name.alias("station_name"),
        X.name_changed("station_name").alias("name_fixed"),
        X.soft_int("capacity").alias("capacity"),
        lat.alias("latitude"), lon.alias("longitude"),
        strip(F.col("town_code")).alias("town_code"), strip(F.col("town_name")).alias("town_name"),
    )
    return out if squash_names else out.drop("name_fixed")
