"""Session settings and shared storage locations.

The job relies on two session properties:

* ``spark.sql.session.timeZone = UTC``: ingest timestamps travel as ISO text
  with a ``Z`` suffix and are turned into wall-clock (NTZ) UTC times.
* AQE with partition coalescing and skew handling, so that shuffle partition
  counts follow the data instead of a fixed number.

Scratch data (bronze written by a query, exported tables, audit rows) goes
below the session's checkpoint directory, which on a cluster is the shared
folder named by ``spark.checkpoint.dir``. A local temporary folder is only
used when no checkpoint directory is configured and the master is local
(unit tests); a cluster session without the setting is refused.

Shuffles of a job run are sized from the bytes it reads (``sized_for``).
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SESSION_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python call sites are not recorded for every column expression: that is
    # several JVM round trips per function call while plans are being built,
    # only to enrich error messages.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "faresight", extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the job's settings.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them unset and let the submitter decide.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_job_conf(spark)
    return spark


# Shuffle sizing. AQE merges small shuffle partitions after each map stage but
# never splits an ordinary large one, so the initial count has to be large
# enough for the biggest shuffle of a run.
SHUFFLE_BYTES_PER_STORED_BYTE = 2.0   # compressed parquet -> shuffle data, rough

STORED_FILES_SCHEMA = "path string, length long, modified long"


def _bytes_conf(spark: SparkSession, key: str, default: str) -> int:
    text = spark.conf.get(key, default)
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils
               .byteStringAsBytes(text))


def stored_files(spark: SparkSession, locations: Iterable[str]) -> DataFrame:
    """(path, length, modified) of every parquet file below paths or glob patterns.

    A scan that lists and reads no content, so the listing is Spark's own
    (parallel for many folders) and the files are rows, not driver objects.
    """
    existing = [p for p in locations if path_exists(spark, p)]
    if not existing:
        return spark.createDataFrame([], STORED_FILES_SCHEMA)
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(existing)
                 .select("path", "length", F.unix_micros("modificationTime").alias("modified")))


def stored_bytes(spark: SparkSession, locations: Iterable[str]) -> int:
    """Total size of the files below paths or glob patterns."""
    return stored_files(spark, locations).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def shuffle_settings(spark: SparkSession, input_bytes: int,
                     expansion: float = SHUFFLE_BYTES_PER_STORED_BYTE) -> dict[str, str]:
    """Initial shuffle partitions for a run reading ``input_bytes``.

    The expected shuffle bytes over the advisory partition size, never fewer
    than ``spark.sql.shuffle.partitions`` (AQE then coalesces them to the
    advisory size); there is no upper bound.
    """
    advisory = _bytes_conf(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    floor = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    wanted = math.ceil(input_bytes * expansion / max(advisory, 1))
    return {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(floor, wanted))}


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int) -> Iterator[dict[str, str]]:
    """Apply ``shuffle_settings`` for the duration of a block, then restore.

    An initial partition count the caller set explicitly is kept.
    """
    settings = shuffle_settings(spark, input_bytes)
    previous = {key: spark.conf.get(key, None) for key in settings}
    pinned = {key for key, value in previous.items()
              if value is not None and key.endswith("initialPartitionNum")}
    applied = {key: value for key, value in settings.items() if key not in pinned}
    for key, value in applied.items():
        spark.conf.set(key, value)
    try:
        yield applied
    finally:
        for key in applied:
            if previous[key] is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, previous[key])


def apply_job_conf(spark: SparkSession) -> None:
    """Set the one runtime property that the results of the job depend on."""
    spark.conf.set("spark.sql.session.timeZone", SESSION_CONF["spark.sql.session.timeZone"])


def shared_root(spark: SparkSession) -> str:
    """Shared folder for data the job writes between stages.

    Uses the session's checkpoint directory (``spark.checkpoint.dir``). Only
    when none is configured and the master is local, as in unit tests, a
    local temporary folder is created and registered as the checkpoint
    directory; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # executors on other machines cannot see a folder on the driver
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="faresight-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused location under the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def delete_partitions(spark: SparkSession, table_dir: str, column: str, values) -> None:
    """Remove ``{table_dir}/{column}=<value>`` directories (partitions left empty).

    A dynamic partition overwrite only replaces partitions that receive rows;
    a partition whose rows all moved elsewhere is removed here, through the
    Hadoop file system of the path (any scheme the cluster supports).
    """
    for value in values:
        delete_path(spark, f"{table_dir.rstrip('/')}/{column}={value}")


def delete_path(spark: SparkSession, location: str) -> None:
    """Recursively delete a location through its Hadoop file system, if it exists."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def delete_files(spark: SparkSession, files: Iterable[str]) -> int:
    """Delete single files, and of their folders those that are empty then; returns the files.

    A folder that holds something, also since a moment, stays.
    """
    jvm, fs, deleted, folders = spark.sparkContext._jvm, None, 0, set()
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(name)
        fs = fs or path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(path, False)
        folders.add(name.rsplit("/", 1)[0])
        deleted += 1
    for name in folders:
        path = jvm.org.apache.hadoop.fs.Path(name)
        if not fs.getContentSummary(path).getFileCount():
            try:
                fs.delete(path, False)
            except Exception:
                if not fs.getContentSummary(path).getFileCount():
                    raise
    return deleted


def list_matches(spark: SparkSession, pattern: str) -> list[str]:
    """Locations matching a path or glob pattern, sorted (a listing, no job)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path)
    return sorted(str(status.getPath()) for status in (found or []))


def count_matches(spark: SparkSession, pattern: str) -> int:
    """Number of locations matching a path or glob pattern (a listing, no job)."""
    return len(list_matches(spark, pattern))


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any location matches a path or glob pattern."""
    return count_matches(spark, pattern) > 0


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Replace ``target`` by ``source`` (delete, then rename on the same file system).

    Readers may see the target missing between the two steps; on object
    stores the rename is a copy.
    """
    jvm = spark.sparkContext._jvm
    src = jvm.org.apache.hadoop.fs.Path(source)
    dst = jvm.org.apache.hadoop.fs.Path(target)
    fs = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(dst):
        fs.delete(dst, True)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, location: str, text: str) -> None:
    """Write a small driver-side document (a run summary, a check report) to one
    file through the location's Hadoop file system, replacing it; no Spark job."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def create_text(spark: SparkSession, location: str, text: str) -> bool:
    """Write a small document to a file that must not be there yet; False if it is. Of several that want
    the same file one gets it. For a moment readers may find the file empty."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() == "file":
        # the local file system of Hadoop looks and then creates, which two can do at a time
        fs.mkdirs(path.getParent())
        try:
            with open(path.toUri().getPath(), "x", encoding="utf-8") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(path, False)
    except Exception:
        if fs.exists(path):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def replace_text(spark: SparkSession, location: str, text: str) -> None:
    """Like ``write_text``, but a reader finds the old document or the new one, never a part: the text is
    written beside it and put in its place by one rename."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    beside = f"{location}.{uuid.uuid4().hex[:8]}"
    write_text(spark, beside, text)
    over = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    over[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    source, target = hadoop.Path(beside), hadoop.Path(location)
    hadoop.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration()).rename(source, target, over)


def read_text(spark: SparkSession, location: str) -> str | None:
    """Content of one small file written by ``write_text``; None when absent."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
