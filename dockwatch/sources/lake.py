"""Lake zones: status documents and messages in, raw / aggregated / clean zones out and back."""

import json
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from dockwatch import schemas as S
from dockwatch.functions import text as X
from dockwatch.session import delete_folder, fixed_rows

# fixed value: zone files sit under date=YYYY-MM-DD and carry HHMMSS in their file or folder name
FILE_KEY = r"date=(\d{4}-\d{2}-\d{2})/(?:[^/]*[_=])(\d{6})"

DOCUMENT = "struct<lastUpdatedOther:bigint,data:struct<stations:array<string>>>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole feed documents, one row per file: ``doc`` text."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "doc")


def explode_snapshot(docs: DataFrame, collected_at="polled_at", use_server_time=False) -> DataFrame:
    """One row per station of each document, all stamped with the document's collection time.

    Output: ``station_id``, ``collected_at`` and the station's own JSON text plus the stamp
    (``message``). With ``use_server_time`` the file time of the server is preferred to the
    poller's clock.
    """
    parsed = F.from_json("doc", DOCUMENT)
    stamp = F.col(collected_at).cast("timestamp")
    if use_server_time:
        stamp = F.coalesce(F.timestamp_seconds(parsed["lastUpdatedOther"]), stamp)
    rows = docs.select(stamp.alias("collected_at"), F.explode(parsed["data"]["stations"]).alias("station"))
    iso = F.date_format("collected_at", "yyyy-MM-dd'T'HH:mm:ssXXX")
    # the zone offset is written out, as the feed does: +00:00 instead of Z
    iso = F.regexp_replace(iso, "Z$", "+00:00")
    body = F.expr("substring(station, 1, length(station) - 1)")
    return rows.select(
        F.get_json_object("station", "$.station_id").alias("station_id"),
        "collected_at",
        F.concat(
            body, F.when(F.length("station") > 2, ",").otherwise(""), F.lit('"date_collecte":"'), iso, F.lit('"}')
        ).alias("message"),
    )


def to_kafka_frame(df: DataFrame, key="station_id", value="message", topic=None) -> DataFrame:
    """Keyed messages ready for ``write.format("kafka")``."""
    out = df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))
    return out if topic is None else out.withColumn("topic", F.lit(topic))


def parse_messages(df: DataFrame, value="value") -> DataFrame:
    """Raw message text to the feed fields, all text."""
    return df.select(F.from_json(value, S.STATUS_MESSAGE).alias("m"), F.col(value).alias("message"))


def flatten_raw_status(df: DataFrame, value="value") -> DataFrame:
    """Raw messages to one all-text row each, the two bike types in columns of their own."""
    parsed = parse_messages(df, value)
    types = X.merge_type_maps("m.num_bikes_available_types")
    return parsed.select(
        F.col("m.station_id").alias("station_id"),
        F.col("m.stationCode").alias("station_code"),
        F.col("m.date_collecte").alias("collected_at"),
        F.col("m.last_reported").alias("updated_at"),
        F.col("m.num_bikes_available").alias("bikes_total"),
        X.type_count(types, S.MECHANICAL).alias("bikes_mechanical"),
        X.type_count(types, S.ELECTRIC).alias("bikes_electric"),
        F.col("m.num_docks_available").alias("docks_free"),
        F.col("m.is_installed").alias("is_installed"),
        F.col("m.is_renting").alias("is_renting"),
        F.col("m.is_returning").alias("is_returning"),
    )


def with_file_key(df: DataFrame) -> DataFrame:
    """Add ``file_path`` and the sortable ``file_key`` YYYY-MM-DD/HHMMSS of a file scan."""
    path = F.col("_metadata.file_path")
    return df.select(
        "*",
        path.alias("file_path"),
        F.concat_ws("/", F.regexp_extract(path, FILE_KEY, 1), F.regexp_extract(path, FILE_KEY, 2)).alias("file_key"),
    )


def files_until(df: DataFrame, cutoff: str, date_column="date") -> DataFrame:
    """Rows of files whose key is at or before ``cutoff`` (YYYY-MM-DD/HHMMSS, inclusive).

    The partition filter prunes whole days first, the file key then trims the last day.
    """
    return df.filter((F.col(date_column).cast("string") <= cutoff.split("/")[0]) & (F.col("file_key") <= cutoff))


def read_raw_status(spark: SparkSession, path: str, cutoff: str = None, root: str = None) -> DataFrame:
    """Raw zone to numbered all-text rows, optionally only the files up to ``cutoff``.

    With ``root``, the folder that holds the zone and its commits, rows of batches that are not committed are left out.

    ``row_id`` is unique and fixed once the caller writes the result (the number depends on the
    layout of the files); write it before using it as a key.
    """
    if root is None:
        lines = spark.read.schema("value string, date date").text(path)
    else:
        lines = committed(spark.read.schema("value string, date date, time string").text(path), root)
    lines = with_file_key(lines)
    if cutoff is not None:
        lines = files_until(lines, cutoff)
    flat = flatten_raw_status(lines)
    return flat.select(F.monotonically_increasing_id().alias("row_id"), *flat.columns)


def read_aggregated(spark: SparkSession, path) -> DataFrame:
    """Aggregated zone with its imposed all-text schema, columns renamed to this package's names."""
    frame = spark.read.schema(S.AGGREGATED_SCHEMA).json(path)
    return frame.select(*[F.col(f).alias(c) for f, c in S.AGGREGATED_FIELDS.items()])


def to_aggregated_fields(df: DataFrame) -> DataFrame:
    """Rename to the field names of the aggregated zone files."""
    return df.select(*[F.col(c).alias(f) for f, c in S.AGGREGATED_FIELDS.items()])


def write_zone(df: DataFrame, root: str, zone: str, written_at) -> None:
    """Append JSON lines to ``zone`` under the date and time of writing.

    A frame with the single column ``value`` is written unchanged, line by line.
    """
    stamped = df.withColumn("date", F.lit(f"{written_at:%Y-%m-%d}")).withColumn("time", F.lit(f"{written_at:%H%M%S}"))
    writer = stamped.write.mode("append").partitionBy("date", "time")
    target = f"{root}/{zone}"
    if df.columns == ["value"]:
        writer.text(target)
    else:
        writer.option("ignoreNullFields", "false").json(target)


def by_day(df: DataFrame) -> DataFrame:
    """Deal rows by their ``date``, a large day over several tasks of even size, so that a write makes few files per day, not one per
    task and day."""
    return df.hint("rebalance", "date")


def write_clean(df: DataFrame, path: str) -> None:
    """Clean zone: Parquet, one folder per collection date; rows are appended."""
    dated = by_day(df.withColumn("date", F.to_date("collected_at")))
    dated.write.mode("append").partitionBy("date").parquet(path)


def write_staging(df: DataFrame, target, jdbc_options=None) -> None:
    """Replace the typed staging table: Parquet folder, or a JDBC table that is truncated, not dropped."""
    if jdbc_options:
        df.write.format("jdbc").mode("overwrite").option("truncate", "true").option("dbtable", target).options(
            **jdbc_options
        ).save()
    else:
        df.write.mode("overwrite").parquet(target)


# --- zones written batch by batch -------------------------------------------------------------
#
# A batch has a label that is the same when it is run again. It opens with a file that fixes its time of writing, so every attempt
# writes the same folders and replaces what an earlier attempt left; it ends with a commit file, and then the open file
# goes. A batch counts from its commit on: readers leave out the folders of open batches, and a batch that is run
# again after its commit writes nothing.

COMMITS = "zone_commits"
COMMIT = "label string, written_at string, messages long, unmatched long, folder string"


def _fs(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete under a hidden name before it gets its own."""
    parent, name = path.rsplit("/", 1)
    fs, hidden = _fs(spark, f"{parent}/_{name}.part")
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    if exists(spark, path):
        delete_folder(spark, path)
    _move(spark, f"{parent}/_{name}.part", path)


def _read_text(spark: SparkSession, path: str) -> str:
    fs, file = _fs(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _fs(spark, path)
    fs.mkdirs(folder)


def begin_batch(spark: SparkSession, root: str, label: str, now: datetime) -> tuple[datetime, dict | None]:
    """Time of writing of a batch, ``now`` if it is new, and its commit if it has one already."""
    opened = f"{root}/{COMMITS}/_open/{label}"
    done = f"{root}/{COMMITS}/{label}.json"
    if exists(spark, done):
        commit = json.loads(_read_text(spark, done))
        delete_folder(spark, opened)
        return datetime.fromisoformat(commit["written_at"]), commit
    if exists(spark, opened):
        return datetime.fromisoformat(_read_text(spark, opened)), None
    make_folder(spark, f"{root}/{COMMITS}/_open")
    _write_text(spark, opened, now.isoformat())
    return now, None


def batch_folder(label: str, written_at: datetime) -> str:
    return f"date={written_at:%Y-%m-%d}/time={written_at:%H%M%S}-{label}"


def write_zone_batch(df: DataFrame, root: str, zone: str, label: str, written_at: datetime) -> None:
    """Write the lines of a batch into its own folder of ``zone``; an earlier attempt of the same batch is replaced."""
    target = f"{root}/{zone}/{batch_folder(label, written_at)}"
    writer = df.write.mode("overwrite")
    if df.columns == ["value"]:
        writer.text(target)
    else:
        writer.option("ignoreNullFields", "false").json(target)


def commit_batch(spark: SparkSession, root: str, label: str, written_at: datetime, messages: int, unmatched: int) -> dict:
    """All zones of the batch are written: from now on it counts."""
    commit = {"label": label, "written_at": written_at.isoformat(), "messages": messages, "unmatched": unmatched,
              "folder": batch_folder(label, written_at)}
    _write_text(spark, f"{root}/{COMMITS}/{label}.json", json.dumps(commit))
    delete_folder(spark, f"{root}/{COMMITS}/_open/{label}")
    return commit


def open_folders(spark: SparkSession, root: str) -> list:
    """``time`` values of the batches that have begun and not ended: one or none per running stream."""
    opened = f"{root}/{COMMITS}/_open"
    out = []
    for label in _children(spark, opened):
        if not exists(spark, f"{root}/{COMMITS}/{label}.json"):
            out.append(batch_folder(label, datetime.fromisoformat(_read_text(spark, f"{opened}/{label}"))).split("time=", 1)[1])
    return out


def committed(df: DataFrame, root: str) -> DataFrame:
    """Rows of a zone scan (with its partition column ``time``) without those of open batches; a partition filter."""
    left_out = open_folders(df.sparkSession, root)
    return df.filter(~F.col("time").cast("string").isin(left_out)) if left_out else df


def read_zone(spark: SparkSession, root: str, zone: str) -> DataFrame:
    """Lines of the committed batches of a zone: ``value, date, time``."""
    return committed(spark.read.schema("value string, date date, time string").text(f"{root}/{zone}"), root)


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(COMMIT).json(f"{root}/{COMMITS}")


def read_committed_batches(spark: SparkSession, root: str, commits: DataFrame) -> DataFrame:
    """Aggregated rows of the batches whose commits are given: one path per batch reaches the driver."""
    folders = sorted({r.folder for r in commits.select("folder").collect()})
    return read_aggregated(spark, [f"{root}/aggregated/{f}" for f in folders])


def zone_counts(spark: SparkSession, zones: dict, root: str = None) -> DataFrame:
    """Records per lake zone; ``zones`` maps a zone name to its path. With ``root`` open batches do not count."""
    def lines(path):
        if root is None:
            return spark.read.text(path)
        return committed(spark.read.schema("value string, date date, time string").text(path), root)

    frames = [
        lines(path).agg(F.count(F.lit(1)).alias("records")).select(F.lit(zone).alias("zone"), "records")
        for zone, path in zones.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write_batch(df: DataFrame, path: str, label: str | Column) -> None:
    """Write rows under date and batch label (a column: each row's own); only the folders of these labels are replaced."""
    df.withColumn("batch", F.lit(label)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "date", "batch").parquet(path)


def read_batches(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Rows of all batches with the columns of ``like`` and their batch label; empty before the first."""
    schema = like.schema.add("batch", "string")
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _children(spark: SparkSession, path: str) -> list:
    """Names of the entries of one folder, without those that readers skip."""
    if not exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = (s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder))
    return sorted(n for n in names if not n.startswith(("_", ".")))


def _move(spark: SparkSession, old: str, new: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    if not path(old).getFileSystem(spark._jsc.hadoopConfiguration()).rename(path(old), path(new)):
        raise OSError(f"cannot move {old} to {new}")


#: Bytes of a file that compaction aims at.
FILE_BYTES = 128 << 20


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, folder = _fs(spark, path)
    return fs.getContentSummary(folder).getLength()


def compact_day(spark: SparkSession, path: str, day: str, file_bytes: int = FILE_BYTES) -> bool:
    """Rewrite all batches of one closed ``day`` into one folder, in files of about ``file_bytes``; False when there is at most one batch.

    The new files are complete under a hidden name before the old folders go, and an interrupted run is finished by
    the next one, so no row is lost or doubled for good. Run it where no other job reads that day at the same time.
    """
    done, ready = f"{path}/date={day}/batch=compacted", f"{path}/_compacted-{day}"
    if not exists(spark, f"{ready}/_SUCCESS"):
        batches = _children(spark, f"{path}/date={day}")
        if len(batches) < 2:
            return False
        rows = spark.read.option("basePath", path).parquet(f"{path}/date={day}").drop("date", "batch")
        files = -(-folder_bytes(spark, f"{path}/date={day}") // file_bytes)
        rows.repartition(max(1, files)).write.mode("overwrite").parquet(ready)
    for name in _children(spark, f"{path}/date={day}"):
        delete_folder(spark, f"{path}/date={day}/{name}")
    _move(spark, ready, done)
    return True


def compact_before(spark: SparkSession, path: str, day: str) -> list:
    """Compact the days before ``day`` that hold more than one batch; one listing per day."""
    days = [n.split("=", 1)[1] for n in _children(spark, path) if n.startswith("date=")]
    return [d for d in days if d < day and compact_day(spark, path, d)]


def day_folder(path: str, day) -> str:
    """Folder of a day (a date or its text); the day NULL is where rows without a day lie."""
    return f"{path}/date={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


def days_with_batch(spark: SparkSession, path: str, batch: str) -> list:
    """Days that hold a folder of the given batch."""
    fs, pattern = _fs(spark, f"{path}/date=*/batch={batch}")
    days = [str(status.getPath().getParent().getName()).split("=", 1)[1] for status in fs.globStatus(pattern) or []]
    return [date.fromisoformat(d) for d in days]


def drop_day(spark: SparkSession, path: str, day) -> None:
    delete_folder(spark, day_folder(path, day))


def keep_schema(spark: SparkSession, path: str, schema) -> None:
    """Note the columns of a table beside its files, so that it can be read while no day has rows."""
    if not exists(spark, f"{path}/_schema.json"):
        make_folder(spark, path)
        _write_text(spark, f"{path}/_schema.json", schema.json())


def read_kept(spark: SparkSession, path: str) -> DataFrame:
    """A table kept by date and batch whose columns were noted."""
    schema = StructType.fromJson(json.loads(_read_text(spark, f"{path}/_schema.json"))).add("batch", "string")
    return spark.read.schema(schema).parquet(path)


def replace_days(df: DataFrame, path: str, days, batch: str) -> None:
    """Replace the given ``days`` of a table kept by date and batch with the rows of ``df`` (column ``date``), as one ``batch``.

    Other days keep their files, and a day without rows is emptied. The new rows are complete under a hidden name, and a plan file
    lists the days, before an old folder goes; ``finish_swap`` ends a swap that was interrupted. Run it where no other job reads
    these days at the same moment.
    """
    spark = df.sparkSession
    finish_swap(spark, path)
    ready = f"{path}/_swap"
    delete_folder(spark, ready)
    df.write.mode("overwrite").partitionBy("date").parquet(f"{ready}/rows")
    made = {n.split("=", 1)[1] for n in _children(spark, f"{ready}/rows") if n.startswith("date=")}
    listed = {str(d): str(d) in made for d in days}
    if not made <= set(listed):
        raise ValueError(f"rows of days that are not replaced: {sorted(made - set(listed))}")
    _write_text(spark, f"{ready}/plan.json", json.dumps({"batch": batch, "days": listed}))
    finish_swap(spark, path)


def finish_swap(spark: SparkSession, path: str) -> bool:
    """Carry out the swap whose plan is written; False if there is none."""
    ready = f"{path}/_swap"
    if not exists(spark, f"{ready}/plan.json"):
        return False
    plan = json.loads(_read_text(spark, f"{ready}/plan.json"))
    for day, has_rows in plan["days"].items():
        new = f"{ready}/rows/date={day}"
        if has_rows and not exists(spark, new):
            continue  # moved before the interruption
        drop_day(spark, path, day)
        if has_rows:
            make_folder(spark, day_folder(path, day))
            _move(spark, new, f"{day_folder(path, day)}/batch={plan['batch']}")
    delete_folder(spark, ready)
    return True


def write_snapshot(df: DataFrame, path: str, name: str, keep: int = 3) -> None:
    """A dimension as a new folder; the copy it was built from stays readable meanwhile.

    Only the newest ``keep`` snapshots stay.
    """
    df.write.mode("errorifexists").parquet(f"{path}/snapshot={name}")
    for old in _children(df.sparkSession, path)[:-keep]:
        delete_folder(df.sparkSession, f"{path}/{old}")


def read_snapshot(spark: SparkSession, path: str, like: DataFrame = None) -> DataFrame:
    """The newest finished snapshot; empty with the columns of ``like`` before the first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/snapshot=*/_SUCCESS")
    done = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder)
    if not done:
        return spark.createDataFrame([], like.schema)
    newest = max(str(status.getPath().getParent()) for status in done)
    return spark.read.parquet(newest) if like is None else spark.read.schema(like.schema).parquet(newest)


def write_target(tables: dict, root: str, name: str = "0") -> None:
    """Store target tables: dimensions as snapshots, readings and type rows by collection date.

    Type rows that carry the date of their reading are written as they are; others find it by their reading.
    """
    dated = tables["reading"].withColumn("date", F.to_date("collected_at"))
    for dimension in ("town", "station", "bike_type"):
        write_snapshot(tables[dimension], f"{root}/{dimension}", name)
    write_batch(by_day(dated), f"{root}/reading", name)
    bikes = tables["reading_bikes"]
    bikes = bikes.filter(F.col("reading_id").isNotNull()) if "date" in bikes.columns else bikes.join(dated.select("reading_id", "date"), "reading_id")
    write_batch(by_day(bikes.select("reading_id", "bike_type_id", "bikes", "date")), f"{root}/reading_bikes", name)


def read_target(spark: SparkSession, root: str) -> dict:
    """The five target tables as DataFrames by name; the facts keep the ``date`` they are stored by."""
    from dockwatch.sources import buckets  # which builds on this module

    dimensions = {n: buckets.read_buckets(spark, f"{root}/{n}") if buckets.newest_manifest(spark, f"{root}/{n}") else read_snapshot(spark, f"{root}/{n}")
                  for n in ("town", "station")}
    facts = {n: spark.read.parquet(f"{root}/{n}").drop("batch") for n in ("reading", "reading_bikes")}
    types = fixed_rows(spark, S.BIKE_TYPES, {"bike_type_id": "int", "type_code": "string", "type_label": "string"})
    return {**dimensions, "bike_type": types, **facts}
