"""Session settings and shared-storage tables that cut lineage."""

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are written for. They are recommendations for the submitter:
# library functions never change the settings of a session they are given.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name="dockwatch", master=None, extra=None):
    """Session with the recommended settings; ``master`` is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local = threading.local()  # lists of the tables stored inside open scratch blocks, per thread
_fallback = {}  # application id -> local folder, when the session names none


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the shared one the cluster names, else a local one.

    A machine-local folder is only acceptable when the whole session is one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    name = spark.sparkContext.applicationId
    if name not in _fallback:
        _fallback[name] = tempfile.mkdtemp(prefix="dockwatch-")
    return _fallback[name]


def _tables_of(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/tables-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder that no other run, day or job uses; ``release`` deletes it with the intermediate tables."""
    return f"{_tables_of(spark)}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application once its results are stored."""
    delete_folder(spark, _tables_of(spark))


@contextmanager
def scratch(spark: SparkSession):
    """Tables stored inside the block are deleted when it ends: what a long-running job makes per batch."""
    stack = _local.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            delete_folder(spark, path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    The columnar copy survives lost executors, prunes columns on every later pass, and gives
    the planner a true byte size, so a lookup is broadcast only when it is really small.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    for stored in _local.__dict__.get("stack", [])[-1:]:
        stored.append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fixed_rows(spark: SparkSession, rows, columns: dict) -> DataFrame:
    """A few constant rows as an inline table; the planner knows its size and needs no hint."""

    def literal(value):
        return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    frame = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")
    return frame.select(*[frame[c].cast(kind) for c, kind in columns.items()])
