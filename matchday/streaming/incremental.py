"""Incremental import as a stream: arriving files are appended unless their period is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from matchday.functions.projections import q
from matchday.operators.joins import distinct_periods, unseen_periods


#: Conditions under which a folder holds no period list: it is absent, or a first write died in it.
NO_LIST = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _known_periods(spark: SparkSession, stored: DataFrame, path: str) -> DataFrame:
    """Periods stored when the stream first started, written once so that a restart sees the same.

    The list is a calendar and goes into one file, which appears whole or not at all.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in NO_LIST:
            raise
    distinct_periods(stored).repartition(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def import_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    stored: DataFrame,
    target: str,
    checkpoint: str,
    redelivered: str = "keep",
) -> None:
    """Process all files that are waiting in ``source``, then stop.

    Rows of a period stored before the stream began are dropped. Each micro-batch writes its own
    partition of ``target`` in overwrite mode, so a batch that is repeated after a failure replaces
    itself, and a period spread over several batches is kept whole. Rows of a period that an earlier
    run brought in are kept, or dropped as delivered again with ``redelivered="drop"``. A run that
    fails closes no period, so the run that resumes it still takes the rest of them.
    """
    if redelivered not in ("keep", "drop"):
        raise ValueError("redelivered is keep or drop")
    list_path = f"{checkpoint}/known-periods"
    known = _known_periods(spark, stored, list_path)
    written = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = unseen_periods(batch, known)
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        written.append(batch_id)

    query = (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if redelivered == "drop" and written:
        arrived = distinct_periods(spark.read.schema(schema).parquet(target))
        arrived.repartition(1).write.mode("append").parquet(list_path)


#: Periods of a season that event time makes room for, and the name of that time.
PERIODS_OF_SEASON, EVENT_TIME = 64, "__period_time"


def period_time(season: str = "season", week: str = "week") -> Column:
    """The period as a time: a day for each, so that a watermark can be counted in periods.

    Times only order the periods. A season has room for more weeks than any calendar has, so the distance over
    the end of a season is larger than within it.
    """
    number = q(season).cast("long") * PERIODS_OF_SEASON + q(week).cast("long")
    return F.timestamp_seconds(number * 86_400)


def import_by_event_time(
    spark: SparkSession,
    source: str,
    schema: StructType,
    keys: Sequence[str],
    target: str,
    checkpoint: str,
    open_periods: int = 4,
    files_per_batch: int | None = None,
) -> int:
    """Append what waits in ``source`` to ``target``, each key of a period once, then stop; returns the rows that came too late.

    A period stays open until one that is more than ``open_periods`` later has been seen in an earlier batch. While it is
    open its rows are told apart by ``keys``, within a run and between runs: the state holds the keys of open periods and
    nothing else, so it does not grow with the table. Rows of a closed period are late, whether delivered
    again or for the first time, and are dropped and counted. A new season closes every period of the one
    before, but for the batch that brings it. Of rows with equal keys in one batch any one stays. Null keys are keys of
    their own; rows without season or week belong to no period and are refused.

    The state is kept under ``checkpoint`` and survives restarts. A batch writes a partition of its own, replaced
    when it is repeated. Large states want the session's RocksDB state store provider. Late rows
    are those of the batches that the session keeps progress of (``spark.sql.streaming.numRecentProgressUpdates``, 100).
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*[q(f.name) for f in schema.fields])
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    arriving = spark.readStream.schema(schema)
    if files_per_batch:
        arriving = arriving.option("maxFilesPerTrigger", files_per_batch)
    whole = F.when(q("season").isNull() | q("week").isNull(), F.raise_error(F.lit("a row has no period"))).otherwise(period_time())
    timed = arriving.parquet(source).withColumn(EVENT_TIME, whole.cast("timestamp"))
    # Spark counts a time at the watermark as late, so it stays an hour behind the last open period
    unique = timed.withWatermark(EVENT_TIME, f"{24 * open_periods + 1} hours").dropDuplicates([EVENT_TIME, *keys])
    query = (
        unique.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
