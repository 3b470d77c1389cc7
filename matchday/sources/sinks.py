"""Table, partition and model sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from matchday.functions.predicates import any_null
from matchday.functions.projections import q
from matchday.operators.skew import require_unique
from matchday.workspace import materialise

PREDICTION_SCHEMA = StructType(
    [
        StructField("game_id", StringType(), False),
        StructField("home_team", StringType()),
        StructField("away_team", StringType()),
        StructField("predicted_outcome", IntegerType()),
    ]
)

TRACKED_PREDICTION_SCHEMA = StructType(
    [
        *PREDICTION_SCHEMA.fields,
        StructField("prediction_week", IntegerType()),
        StructField("prediction_timestamp", TimestampType()),
        StructField("created_at", TimestampType()),
    ]
)

_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def write_table(df: DataFrame, table: str, mode: str, path: str | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def replace_table(df: DataFrame, table: str, path: str | None = None) -> None:
    write_table(df, table, "overwrite", path)


def append_table(df: DataFrame, table: str, path: str | None = None) -> None:
    write_table(df, table, "append", path)


#: Types that widen without loss, narrowest first. Text takes nothing else, and nothing takes text.
WIDENING = ("byte", "short", "integer", "long", "double")


def evolved_schema(stored: StructType, new: StructType) -> StructType:
    """All columns of both, stored ones first; a column of both has the wider type.

    Raises where neither type holds the other. A long becomes a double only next to a double: such a
    column loses digits beyond 53 bits, as any number column of a feed does.
    """
    fields = {f.name: f for f in stored.fields}
    for f in new.fields:
        known = fields.get(f.name)
        if known is None or known.dataType == f.dataType:
            fields.setdefault(f.name, StructField(f.name, f.dataType))
            continue
        names = [known.dataType.typeName(), f.dataType.typeName()]
        if not all(n in WIDENING for n in names):
            raise ValueError(f"{f.name} is stored as {names[0]} and arrives as {names[1]}")
        wider = max((known, f), key=lambda x: WIDENING.index(x.dataType.typeName()))
        fields[f.name] = StructField(f.name, wider.dataType)
    return StructType(list(fields.values()))


def append_evolving(df: DataFrame, path: str) -> StructType:
    """Append to the parquet files at ``path`` whatever columns ``df`` has, and return the schema of all of them.

    Every append is a folder of its own, named by its number, written as its rows came; nothing stored is rewritten.
    :func:`read_evolving` reads old and new folders by the common schema. A column whose type cannot be widened is refused
    before anything is written.
    """
    spark = df.sparkSession
    versions = stored_versions(spark, path)
    schema = reduce(evolved_schema, [spark.read.parquet(v).schema for v in versions], StructType())
    schema = evolved_schema(schema, df.schema)
    df.write.mode("errorifexists").parquet(f"{path}/append={len(versions):06d}")
    return schema


def stored_versions(spark: SparkSession, path: str) -> list[str]:
    """The folders of :func:`append_evolving` that were written to the end, in order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/append=*/_SUCCESS")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(str(x.getPath().getParent()) for x in (found or []))


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """All appended rows: a column that an append did not have is NULL in its rows, a narrower one is widened."""
    versions = [spark.read.parquet(v) for v in stored_versions(spark, path)]
    schema = reduce(evolved_schema, [v.schema for v in versions], StructType())

    def conformed(df: DataFrame) -> DataFrame:
        return df.select(*[(q(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])

    return reduce(DataFrame.unionByName, [conformed(v) for v in versions])


def store_query(spark: SparkSession, text: str, table: str, if_exists: str = "replace", path: str | None = None, **frames: DataFrame) -> DataFrame:
    """Run a query text and store its result; ``if_exists`` is replace, append or fail."""
    write_table(spark.sql(text, **frames), table, _MODES[if_exists], path)
    return spark.table(table)


def reset_predictions(spark: SparkSession, table: str, path: str | None = None, schema: StructType = PREDICTION_SCHEMA) -> None:
    """An empty predictions table with a fixed schema, whatever was there before."""
    replace_table(spark.createDataFrame([], schema), table, path)


#: Buckets of a keyed predictions table.
KEY_BUCKETS = 16


def _append_keyed(df: DataFrame, table: str, path: str | None, key: str, buckets: int) -> None:
    """A task for each bucket, so that an import adds one file to it."""
    writer = df.repartition(buckets, q(key)).write.bucketBy(buckets, key).sortBy(key).mode("append")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def add_predictions(
    spark: SparkSession, new: DataFrame, table: str, path: str | None = None, on_conflict: str = "fail", buckets: int = KEY_BUCKETS
) -> None:
    """Append predictions to a table keyed by ``game_id``, creating it if absent.

    A game that occurs twice in ``new`` is an error. A game already stored is an error with
    ``on_conflict="fail"`` and left as it is with ``"skip"``. On error nothing is written. A
    ``prediction_timestamp`` that ``new`` does not have is the time of this call, as is ``created_at``.

    The table is bucketed by the key, so the check against it moves the new rows only. ``new`` is computed
    once, into a staged copy, and published by one append at the end.
    """
    rows = new.withColumn("created_at", F.current_timestamp())
    if "prediction_timestamp" not in rows.columns:
        rows = rows.withColumn("prediction_timestamp", F.current_timestamp())
    present = set(rows.columns)
    columns = [
        (q(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in TRACKED_PREDICTION_SCHEMA.fields
    ]
    staged = materialise(rows.select(*columns), "predictions")
    require_unique(staged, ["game_id"])
    if not spark.catalog.tableExists(table):
        _append_keyed(spark.createDataFrame([], TRACKED_PREDICTION_SCHEMA), table, path, "game_id", buckets)
    stored = spark.table(table)
    if on_conflict == "fail" and not conflicts(staged, stored).isEmpty():
        raise ValueError("a game already has a prediction")
    _append_keyed(conflicts(staged, stored, "left_anti"), table, path, "game_id", buckets)


def conflicts(new: DataFrame, stored: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``new`` whose game is stored (or, with ``left_anti``, is not)."""
    keys = stored.select(q("game_id").alias("stored_id"))
    return new.join(keys, q("game_id") == q("stored_id"), how)


def write_periods(df: DataFrame, path: str, keys: Sequence[str] = ("season", "week")) -> None:
    """Replace exactly the partitions that ``df`` holds rows of.

    Running it again changes nothing. The rebalance hint gathers small partitions into few files
    and lets Spark split a large one over several tasks.
    """
    balanced = df.hint("rebalance", *keys)
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_missing_records(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """Snapshot of the rows with a NULL in one of ``columns``."""
    df.where(any_null(columns)).write.mode("overwrite").parquet(path)


def write_training_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
