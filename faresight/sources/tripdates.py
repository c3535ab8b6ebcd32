"""Where silver's trips lie: a table of (trip_id, pickup_date) bucketed by id.

Ids made from the trip itself hold its pickup time and need no entry. For all
others the table names every date on which silver holds, or has held, a row of
the id. A batch reads the buckets of its own ids, so finding stored copies
costs what the batch touches and not what silver holds.

Layout: ``{silver}.ids-<n>/bucket=<b>/...`` with a small pointer file
``{silver}.ids`` that names the folder, its number of buckets, how often it was
appended to, and the state of silver that it is right for. Entries are only
added, before silver changes: a run that stops in between leaves a table that
names too many dates, which costs a read and changes no result. After
``MOST_APPENDS`` the entries that are left are written anew. A table that is
not right for silver's state is not used and is built from silver again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faresight.functions.columns import TRIP_ID_PREFIX
from faresight.session import delete_path, path_exists, read_text, write_text

PAIRS_SCHEMA = "trip_id string, pickup_date date"

#: Ids of a bucket: some 100 MB. The number of buckets is set whenever the table is written anew.
BUCKET_IDS = 4_000_000
#: Appends, each of which leaves a file in every bucket it touches, before the table is written anew.
MOST_APPENDS = 24
#: Buckets that a batch names to the scan; a batch that touches more reads the table whole.
NAMED_BUCKETS = 4_000


def pointer_path(silver_dir: str) -> str:
    return f"{silver_dir.rstrip('/')}.ids"


def foreign(trips: DataFrame) -> DataFrame:
    """(trip_id, pickup_date) of trips whose id does not tell the date, the null id included."""
    own = F.col("trip_id").startswith(TRIP_ID_PREFIX)
    return trips.where(own.isNull() | ~own).select("trip_id", "pickup_date")


def foreign_rows() -> Column:
    """Aggregate: how many rows ``foreign`` would give."""
    own = F.col("trip_id").startswith(TRIP_ID_PREFIX)
    return F.count_if(own.isNull() | ~own).alias("foreign_rows")


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("trip_id"), F.lit(buckets)).cast("int")


def _same_pair(a: DataFrame, b: DataFrame) -> Column:
    return a["trip_id"].eqNullSafe(b["trip_id"]) & (a["pickup_date"] == b["pickup_date"])


@dataclass(frozen=True)
class TripDates:
    spark: SparkSession
    silver_dir: str
    folder: str       # last part of the path; it lies beside silver
    buckets: int
    appends: int

    @property
    def location(self) -> str:
        return f"{self.silver_dir.rstrip('/').rsplit('/', 1)[0]}/{self.folder}"

    def rows(self) -> DataFrame:
        return (self.spark.read.schema(f"{PAIRS_SCHEMA}, bucket int").option("basePath", self.location)
                    .parquet(self.location))

    def no_pairs(self) -> DataFrame:
        """What ``dates_of`` gives for trips of which none has an entry."""
        return self.spark.createDataFrame([], PAIRS_SCHEMA)

    def dates_of(self, trips: DataFrame, stage: str) -> DataFrame:
        """The entries of the trips' ids, kept at ``stage``: what is read for it are the ids' buckets. A run that
        stopped may have left an entry twice."""
        own = foreign(trips).select("trip_id")
        # buckets straight from the rows, whose ids need not be dealt out for that
        named = [r["bucket"] for r in own.select(bucket_of(self.buckets).alias("bucket")).distinct()
                 .limit(NAMED_BUCKETS + 1).collect()]
        ids = own.distinct().withColumn("bucket", bucket_of(self.buckets))
        rows = self.rows()
        if len(named) <= NAMED_BUCKETS:
            rows = rows.where(F.col("bucket").isin(named)) if named else rows.limit(0)
        same = (rows["bucket"] == ids["bucket"]) & rows["trip_id"].eqNullSafe(ids["trip_id"])
        rows.join(ids, same, "left_semi").select("trip_id", "pickup_date").write.parquet(stage)
        return self.spark.read.schema(PAIRS_SCHEMA).parquet(stage)

    def with_trips(self, trips: DataFrame, known: DataFrame) -> TripDates:
        """The table with entries for ``trips``, of which ``known`` are there (``dates_of`` of the same ids)."""
        new = foreign(trips).distinct()
        new = new.join(known, _same_pair(new, known), "left_anti").withColumn("bucket", bucket_of(self.buckets))
        # whether there are new ones is observed on the write: a look beforehand would join them all once more
        obs = Observation(f"entries_{uuid.uuid4().hex[:8]}")
        (_dealt(new).observe(obs, F.count(F.lit(1)).alias("rows"))
         .write.mode("append").partitionBy("bucket").parquet(self.location))
        return replace(self, appends=self.appends + 1) if obs.get["rows"] else self

    def sealed(self, state: str) -> TripDates:
        """Declare the table right for a state of silver; from ``MOST_APPENDS`` on it is written anew first."""
        table, old = self, None
        if self.appends >= MOST_APPENDS:
            pairs = self.rows().select("trip_id", "pickup_date").distinct()
            table, old = _write(self.spark, self.silver_dir, pairs, pairs.count()), self
        write_text(self.spark, pointer_path(self.silver_dir), json.dumps(
            {"folder": table.folder, "buckets": table.buckets, "appends": table.appends, "state": state}))
        if old is not None:
            delete_path(self.spark, old.location)
        return table


def _dealt(pairs: DataFrame) -> DataFrame:
    """Rows of a bucket together, so that a bucket gets one file (AQE splits a large one)."""
    return pairs.hint("rebalance", "bucket")


def _write(spark: SparkSession, silver_dir: str, pairs: DataFrame, rows: int) -> TripDates:
    buckets = max(1, -(-rows // BUCKET_IDS))
    table = TripDates(spark, silver_dir, f"{pointer_path(silver_dir).rsplit('/', 1)[-1]}-{uuid.uuid4().hex[:8]}", buckets, 0)
    if not rows:
        pairs = spark.createDataFrame([], PAIRS_SCHEMA)
    _dealt(pairs.withColumn("bucket", bucket_of(buckets))).write.partitionBy("bucket").parquet(table.location)
    return table


def rebuild(spark: SparkSession, silver_dir: str, silver: DataFrame, rows: int) -> TripDates:
    """A new table from silver's ids and dates; the one before is removed. ``rows`` says how many of silver's
    rows need an entry, at most; without any, silver is not read."""
    table, before = _write(spark, silver_dir, foreign(silver), rows), _pointer(spark, silver_dir)
    # no state until the run that asked for it is through
    write_text(spark, pointer_path(silver_dir), json.dumps({"folder": table.folder, "buckets": table.buckets, "appends": 0}))
    if before:
        delete_path(spark, TripDates(spark, silver_dir, before["folder"], 1, 0).location)
    return table


def _pointer(spark: SparkSession, silver_dir: str) -> dict | None:
    text = read_text(spark, pointer_path(silver_dir))
    return json.loads(text) if text else None


def opened(spark: SparkSession, silver_dir: str, state: str | None) -> TripDates | None:
    """The table if it is right for this state of silver."""
    held = _pointer(spark, silver_dir)
    if not held or state is None or held.get("state") != state:
        return None
    table = TripDates(spark, silver_dir, held["folder"], held["buckets"], held["appends"])
    return table if path_exists(spark, table.location) else None
