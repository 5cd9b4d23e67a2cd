"""Live path: status messages to the raw and aggregated zones, then incremental cleaning and load."""

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from dockwatch import schemas as S
from dockwatch.operators import load
from dockwatch.operators.asof import asof_version
from dockwatch.operators.relations import enrich_latest
from dockwatch.plans.readings import observe_run, split_valid, type_readings
from dockwatch.sources import buckets, lake
from dockwatch.sources.reference import keep_groups, read_newest_version
from dockwatch.operators.constraints import require_valid_dimensions
from dockwatch.session import materialise, scratch

POLL = "60 seconds"
CLEANING_INTERVAL = "120 seconds"


def read_status_stream(spark: SparkSession, source: str, fmt: str = "kafka", **options) -> DataFrame:
    """Stream of raw messages as ``value``: a topic read from the earliest offset, or a folder of text files."""
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", source).option("startingOffsets", "earliest")
        return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))
    return spark.readStream.format("text").options(**options).load(source).select("value")


def lag_of(query) -> dict:
    """Rows per source that a running query has still to read, from its last progress (None when unknown)."""
    progress = query.lastProgress
    sources = progress["sources"] if progress else []
    return {s["description"]: (s.get("metrics") or {}).get("maxOffsetsBehindLatest") for s in sources}


def trigger_of(once: bool, interval: str) -> dict:
    return {"availableNow": True} if once else {"processingTime": interval}


def latest_codes(flat: DataFrame, known: DataFrame) -> DataFrame:
    """Fill missing station codes with the last code seen per station id (``known``: station_id, station_code, seen_at)."""
    pairs = known.groupBy("station_id").agg(F.max_by("station_code", F.struct("seen_at", "station_code")).alias("known_code"))
    lost = flat.filter(F.col("station_code").isNull()).join(pairs, "station_id", "left")
    return flat.filter(F.col("station_code").isNotNull()).unionByName(
        lost.withColumn("station_code", F.col("known_code")).drop("known_code")
    )


def carry_code(batch: DataFrame, store: str) -> DataFrame:
    """Fill the codes of a micro-batch from all batches before it and remember its own new pairs.

    The memory is a table of one row per station id with its last known code and the time it was seen, stored as
    snapshots: unlike keyed operator state it can be read by other jobs and starts again from storage after a crash.
    A batch that is run again finds its own codes in it and gives the same rows.
    """
    spark = batch.sparkSession
    coded = batch.filter(F.col("station_code").isNotNull() & F.col("station_id").isNotNull())
    now = coded.groupBy("station_id").agg(
        F.max_by("station_code", F.struct("collected_at", "station_code")).alias("station_code"), F.max("collected_at").alias("seen_at"))
    seen = lake.read_snapshot(spark, store, now)
    newest = seen.unionByName(now).groupBy("station_id").agg(
        F.max_by("station_code", F.struct("seen_at", "station_code")).alias("station_code"), F.max("seen_at").alias("seen_at"))
    lake.write_snapshot(newest, store, f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}")
    return latest_codes(batch, lake.read_snapshot(spark, store, now))


def process_batch(batch: DataFrame, root: str, reference_path: str, min_named: int = None, code_store: str = None,
                  label: str = None) -> dict | None:
    """One micro-batch into both zones: raw lines unchanged, and enriched rows. Returns its commit, None for an empty batch.

    The reference is resolved again for each batch, so a newer file is picked up at once. A batch
    that comes before any reference fails, and is read again when the query restarts.

    Both zones count together: the batch is open until both are written and is then committed (``sources.lake``). Run again with
    the same ``label`` it replaces what an attempt before its commit has left, and does nothing after it.
    """
    spark = batch.sparkSession
    if batch.isEmpty():
        return None
    label = uuid.uuid4().hex if label is None else label
    written_at, commit = lake.begin_batch(spark, root, label, datetime.now(timezone.utc))
    if commit is not None:
        return commit
    # zones take the same rows twice: the source is read once
    kept = batch.persist()
    try:
        newest = read_newest_version(spark, reference_path, min_named)
        if newest is None:
            raise RuntimeError("no station reference yet")
        flat = lake.flatten_raw_status(kept.select("value"))
        if code_store:
            flat = carry_code(flat, code_store)
        seen = Observation()
        enriched = enrich_latest(flat, newest).observe(
            seen, F.count(F.lit(1)).alias("messages"), F.count_if(~F.col("matched")).alias("unmatched"))
        lake.write_zone_batch(kept.select("value"), root, "raw/api", label, written_at)
        lake.write_zone_batch(lake.to_aggregated_fields(enriched), root, "aggregated", label, written_at)
        counts = seen.get
        return lake.commit_batch(spark, root, label, written_at, counts["messages"], counts["unmatched"])
    finally:
        kept.unpersist()


def run_two_zone_stream(messages: DataFrame, root: str, reference_path: str, checkpoint: str, once: bool = False,
                        min_named: int = None, code_store: str = None):
    """Start the message stream. Offsets are committed after both zones are; a batch that is run again in between is known by its label.

    Each micro-batch adds a line with its messages and unmatched messages to ``stream_runs`` below ``root``; a batch that
    is run again replaces its line. ``stream_report`` reads them beside the lag of the running query. How much one batch
    takes is set where the messages are read (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``).
    """
    def handle(batch, batch_id):
        spark = batch.sparkSession
        label, started_at = batch_label(spark, batch_id), datetime.now(timezone.utc)
        commit = process_batch(batch, root, reference_path, min_named, code_store, label)
        if commit is None:
            return
        line = spark.createDataFrame([(label, started_at, commit["messages"], commit["unmatched"])], STREAM_LOG)
        lake.write_batch(line.coalesce(1).withColumn("date", F.to_date("started_at")), f"{root}/stream_runs", label)

    return messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(
        **trigger_of(once, POLL)).start()


STREAM_LOG = "run_id string, started_at timestamp, messages long, unmatched long"


def stream_report(spark: SparkSession, root: str, query=None) -> DataFrame:
    """Messages and unmatched messages per micro-batch, and the rows the given running query has still to read."""
    lags = [int(v) for v in (lag_of(query) if query is not None else {}).values() if v is not None]
    lag = F.lit(sum(lags) if lags else None).cast("bigint")
    lines = spark.read.schema(STREAM_LOG).parquet(f"{root}/stream_runs")
    return lines.select("run_id", "started_at", "messages", "unmatched", lag.alias("lag"))


def dedup_stream(df: DataFrame, delay: str, time: str = "collected_at") -> DataFrame:
    """Drop repeated messages inside the watermark; what slips through is stopped by the load."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(["station_id", time])


def load_batch(batch: DataFrame, root: str, label: str = "batch", drop_silent: bool = False, station_buckets: int = None) -> dict:
    """Clean one batch of aggregated rows and load it into the clean zone and the target tables.

    Everything a batch writes sits in folders of its own ``label``, so a batch that is run again
    replaces its own rows; rows of other batches are left out by an anti join. The dimensions are
    written as new snapshots, never in place. A row that the target could not take is rejected before; should the
    dimensions still break a rule of the model, the batch stops before anything counts.

    With ``station_buckets`` (or once it was given) the stations lie in hash buckets, of which a batch rewrites those it touches
    (``sources.buckets``); else they are a snapshot as a whole, which is cheaper while they are few.
    """
    with scratch(batch.sparkSession):
        return _load_batch(batch, root, label, drop_silent, station_buckets)


def _load_batch(batch: DataFrame, root: str, label: str, drop_silent: bool, station_buckets: int) -> dict:
    spark = batch.sparkSession
    started_at = datetime.now(timezone.utc)
    files = batch.select(F.input_file_name().alias("file")).filter("file <> ''").distinct()
    n_files = files.count()
    observed, seen = observe_run(type_readings(batch), f"load-{label}-{uuid.uuid4().hex}", drop_silent)
    usable, _ = split_valid(observed, drop_silent)
    staged = materialise(usable, "staged")
    counts = seen.get

    types = load.seed_types(spark)
    target = f"{root}/target"
    towns = lake.read_snapshot(spark, f"{target}/town", load.towns_of(staged))
    snapshot = f"{started_at:%Y%m%dT%H%M%S%f}"
    towns_now = materialise(load.insert_absent(towns, load.towns_of(staged), "town_code", ["town_name"]), "town")
    like = staged.select(*load.STATION_COLUMNS, F.col("collected_at").alias("seen_at"))
    upsert = "station_id", ["collected_at", "updated_at", "station_code"], ["station_name", "latitude", "longitude", "capacity", "town_code"]
    change = None
    if station_buckets or buckets.newest_manifest(spark, f"{target}/station"):
        change = buckets.upsert_buckets(staged, f"{target}/station", *upsert, like, station_buckets or buckets.BUCKETS)
        stations_now = change.table
    else:
        stations_now = materialise(load.upsert_latest(lake.read_snapshot(spark, f"{target}/station", like), staged, *upsert), "station")
    require_valid_dimensions({"town": towns_now, "station": stations_now, "bike_type": types})
    if not lake.exists(spark, f"{target}/town") or towns_now.count() != towns.count():  # towns are only ever added
        lake.write_snapshot(towns_now, f"{target}/town", snapshot)
    if change is not None:
        change.commit()
    else:
        lake.write_snapshot(stations_now, f"{target}/station", snapshot)

    numbered = load.with_reading_id(staged).withColumn("date", F.to_date("collected_at"))
    known = lake.read_batches(spark, f"{target}/reading", numbered.select(*load.READING_COLUMNS, "date"))
    others = known.filter(F.col("batch") != label)
    tie = ["updated_at", "docks_free", "bikes_mechanical", "bikes_electric", "station_name"]
    inserted = materialise(load.insert_new_readings(others, numbered, tie), "inserted")

    lake.write_batch(inserted.drop("reading_id"), f"{root}/clean/readings", label)
    lake.write_batch(load.insert_children(inserted.select("reading_id", "date", "bikes_mechanical", "bikes_electric"), types, ["reading_id", "date"]),
                     f"{target}/reading_bikes", label)
    lake.write_batch(inserted.select(*load.READING_COLUMNS, "date"), f"{target}/reading", label)

    n_loaded = inserted.count()
    run = {
        "run_id": label, "started_at": started_at, "ended_at": datetime.now(timezone.utc),
        "files": n_files, "rows_raw": counts["rows_raw"], "rows_rejected": counts["rows_rejected"],
        "rows_duplicate": counts["rows_raw"] - counts["rows_rejected"] - n_loaded, "rows_loaded": n_loaded,
    }
    load.record_run(spark, f"{root}/runs", run)
    return run


def batch_label(spark: SparkSession, batch_id: int) -> str:
    """Name of a micro-batch, the same when it is run again, different for every checkpoint."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    return f"{query}-{batch_id}"


BATCHED = ("target/reading", "target/reading_bikes", "clean/readings", "runs", "stream_runs")


def compact_closed(spark: SparkSession, root: str, before) -> dict:
    """Join the per-batch folders of the days before ``before`` (a date) in every table the live path writes."""
    return {name: lake.compact_before(spark, f"{root}/{name}", f"{before:%Y-%m-%d}") for name in BATCHED}


def run_incremental(spark: SparkSession, root: str, checkpoint: str, once: bool = True, drop_silent: bool = False, compact: bool = True,
                    committed: bool = True, station_buckets: int = None, **options):
    """Start the cleaning job over the batches of the aggregated zone it has not read yet.

    The stream follows the commit files of the zones, so it never sees a batch before its end, nor twice. A zone that another program
    fills without commits is followed file by file with ``committed=False``. ``options`` go to the file source, for example
    ``maxFilesPerTrigger`` (commits or files): a long history then comes in many batches.
    With ``compact`` the first batch of a calendar day joins the folders of the days that ended two days before, between
    its own reads and writes, so no other job should read those days at that moment.
    """
    last = []
    if committed:
        lake.make_folder(spark, f"{root}/{lake.COMMITS}")
        source = spark.readStream.schema(lake.COMMIT).options(**options).json(f"{root}/{lake.COMMITS}")
    else:
        source = spark.readStream.schema(S.AGGREGATED_SCHEMA).options(**options).json(f"{root}/aggregated")
        source = source.select(*[F.col(f).alias(c) for f, c in S.AGGREGATED_FIELDS.items()])

    def handle(batch, batch_id):
        if not batch.isEmpty():
            today = datetime.now(timezone.utc).date()
            if compact and last != [today]:
                last[:] = [today]
                compact_closed(spark, root, today - timedelta(days=1))
            rows = lake.read_committed_batches(batch.sparkSession, root, batch) if committed else batch
            load_batch(rows, root, batch_label(spark, batch_id), drop_silent, station_buckets)

    return source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(
        **trigger_of(once, CLEANING_INTERVAL)).start()


def enrich_asof(flat: DataFrame, reference: DataFrame, min_named: int = None) -> DataFrame:
    """Enrichment by collection time instead of arrival time: a replay gives the same rows."""
    usable = reference if min_named is None else keep_groups(reference, ["version_ts"], "station_name", min_named)
    timed = flat.withColumn("at", F.try_to_timestamp(F.col("collected_at")))
    picks = asof_version(timed, usable, time="at", fallback=True)
    columns = ["station_code", "station_name", "capacity", "coordinates", "town_name", "town_code", "version_ts"]
    named = usable.filter(F.col("station_code").isNotNull()).select(*columns)
    # messages without a code match nothing: they pass by the join instead of meeting in one task
    placed = timed.join(picks, "at", "left")
    coded = placed.filter(F.col("station_code").isNotNull()).join(named, ["version_ts", "station_code"], "left")
    lost = placed.filter(F.col("station_code").isNull())
    return coded.unionByName(lost, allowMissingColumns=True).drop("version_ts", "at")
