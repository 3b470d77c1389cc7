"""Sinks, incremental import and the streaming import."""

import uuid

import pytest
from pyspark.errors import AnalysisException

from matchday.operators.joins import distinct_periods, unseen_periods
from matchday.sources import feeds, sinks
from matchday.streaming.incremental import import_by_event_time, import_stream
from matchday.workspace import materialise, new_folder

from .helpers import rows


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name, new_folder(spark, "test")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def frame(spark, *values):
    return spark.createDataFrame(list(values), "season int, week int, v int")


def test_import_twice_adds_nothing(spark, table):
    name, path = table
    feed = feeds.frame_feed(frame(spark, (1999, 1, 1), (1999, 1, 2), (2000, 1, 3), (2001, 1, 4)))
    feeds.import_new(spark, feed, [1999, 2000], name, path)
    assert rows(spark.table(name).select("v")) == [(1,), (2,), (3,)]
    feeds.import_new(spark, feed, [1999, 2000, 2001], name, path)
    feeds.import_new(spark, feed, [1999, 2000, 2001], name, path)
    assert rows(spark.table(name).select("v")) == [(1,), (2,), (3,), (4,)]


def test_import_reads_the_index_and_repeats_what_was_interrupted(spark, table):
    name, path = table
    first = frame(spark, (1999, 1, 1), (1999, 2, 2), (None, None, 9))
    feeds.import_new(spark, feeds.frame_feed(first), None, name, path)
    assert rows(spark.table(feeds.index_name(name)).select("season", "week", "rows")) == [(None, None, 1), (1999, 1, 1), (1999, 2, 1)]
    # an import that wrote its rows and stopped before the index comes again
    whole = frame(spark, (1999, 1, 1), (1999, 2, 2), (None, None, 9), (1999, 3, 3), (1999, 3, 4))
    with feeds.replaced_partitions(spark):
        whole.where("week = 3").select("v", "season", "week").write.mode("overwrite").insertInto(name)
    feeds.import_new(spark, feeds.frame_feed(whole), None, name, path)
    assert rows(spark.table(name).select("v")) == [(1,), (2,), (3,), (4,), (9,)]
    later = frame(spark, (1999, 3, 5), (2000, 1, 6))
    feeds.import_new(spark, feeds.frame_feed(later), None, name, path, calendar=later)
    assert rows(spark.table(name).select("v")) == [(1,), (2,), (3,), (4,), (6,), (9,)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_calendar_prunes_the_partitions_of_the_feed(spark, table):
    _, path = table
    write = frame(spark, (1999, 1, 1), (1999, 2, 2), (2000, 1, 3)).write
    write.partitionBy("season", "week").parquet(path)
    feed = spark.read.parquet(path)
    wanted = unseen_periods(distinct_periods(feed), frame(spark, (1999, 1, 0), (1999, 2, 0)))
    pruned = feed.where(feeds.in_some_period(wanted))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan or "PartitionFilters: [(season" in plan or "PartitionFilters: [season" in plan
    assert rows(pruned.select("v")) == [(3,)]
    assert feed.where(feeds.in_some_period(wanted.limit(0))).count() == 0


def test_stored_predictions_do_not_move(spark, table):
    name, path = table
    sinks.add_predictions(spark, predictions(spark, "a", "b"), name, path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = sinks.conflicts(predictions(spark, "b", "c"), spark.table(name))
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert rows(joined.select("game_id")) == [("b",)]


def test_bootstrap_reads_what_is_staged(spark, table):
    name, path = table
    sinks.replace_table(frame(spark, (1999, 1, 7)), name, path)
    final = name + "_final"
    feed = feeds.frame_feed(frame(spark, (2000, 1, 8)))
    out = feeds.bootstrap(spark, feed, [2000], name, final, (path, path + "-final"))
    assert rows(out.select("v")) == [(7,)]
    sinks.replace_table(frame(spark).limit(0), name, path)
    assert rows(feeds.bootstrap(spark, feed, [2000], name, None, (path, None)).select("v")) == [(8,)]
    spark.sql(f"DROP TABLE {final}")


def test_store_query_modes(spark, table):
    name, path = table
    text = "SELECT count(*) AS n FROM {df}"
    df = frame(spark, (1999, 1, 1))
    sinks.store_query(spark, text, name, "fail", path, df=df)
    with pytest.raises(AnalysisException):
        sinks.store_query(spark, text, name, "fail", path, df=df)
    assert sinks.store_query(spark, text, name, "append", path, df=df).count() == 2
    assert sinks.store_query(spark, text, name, "replace", path, df=df).count() == 1


def predictions(spark, *ids):
    values = [(i, "A", "B", 1, 5) for i in ids]
    return spark.createDataFrame(values, "game_id string, home_team string, away_team string, predicted_outcome int, prediction_week int")


def test_keyed_predictions(spark, table):
    name, path = table
    sinks.add_predictions(spark, predictions(spark, "a", "b"), name, path)
    with pytest.raises(ValueError):
        sinks.add_predictions(spark, predictions(spark, "b", "c"), name, path)
    assert spark.table(name).count() == 2
    with pytest.raises(ValueError):
        sinks.add_predictions(spark, predictions(spark, "c", "c"), name, path, on_conflict="skip")
    sinks.add_predictions(spark, predictions(spark, "b", "c"), name, path, on_conflict="skip")
    stored = spark.table(name)
    assert rows(stored.select("game_id")) == [("a",), ("b",), ("c",)]
    assert stored.where("created_at IS NULL").count() == 0


def test_writing_a_period_again_changes_nothing(spark):
    path = new_folder(spark, "periods")
    df = frame(spark, (1999, 1, 1), (1999, 2, 2), (2000, 1, 3))
    sinks.write_periods(df, path)
    sinks.write_periods(df.where("season = 1999 AND week = 2"), path)
    assert rows(spark.read.parquet(path).select("season", "week", "v")) == rows(df)
    sinks.write_periods(frame(spark, (1999, 2, 9)), path)
    assert rows(spark.read.parquet(path).select("v")) == [(1,), (3,), (9,)]


def test_materialise_keeps_schema_and_prunes(spark):
    df = frame(spark, (1999, 1, 1), (2000, 2, 2))
    back = materialise(df, "test", ("season",))
    assert back.schema.simpleString() == df.schema.simpleString()
    plan = back.where("season = 2000").select("v")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "ReadSchema: struct<v:int>" in plan


def test_stream_drops_stored_periods_and_resumes(spark):
    source, target, progress = (new_folder(spark, n) for n in ("in", "out", "progress"))
    stored = frame(spark, (1999, 1, 0))
    first = frame(spark, (1999, 1, 1), (2000, 1, 2), (2000, 2, 3))
    first.coalesce(1).write.parquet(source)
    import_stream(spark, source, first.schema, stored, target, progress)
    read = lambda: rows(spark.read.schema(first.schema).parquet(target).select("season", "week", "v"))
    assert read() == [(2000, 1, 2), (2000, 2, 3)]
    import_stream(spark, source, first.schema, stored, target, progress)
    assert len(read()) == 2
    # More rows of a period that the stream itself brought in arrive later: they are kept.
    frame(spark, (2000, 2, 4), (1999, 1, 5)).coalesce(1).write.mode("append").parquet(source)
    import_stream(spark, source, first.schema, stored, target, progress)
    assert read() == [(2000, 1, 2), (2000, 2, 3), (2000, 2, 4)]


def test_stream_starts_after_a_period_list_that_was_never_finished(spark, tmp_path):
    source, target = new_folder(spark, "in"), new_folder(spark, "out")
    (tmp_path / "known-periods" / "_temporary").mkdir(parents=True)
    first = frame(spark, (1999, 1, 1), (2000, 1, 2))
    first.coalesce(1).write.parquet(source)
    import_stream(spark, source, first.schema, frame(spark, (1999, 1, 0)), target, str(tmp_path))
    assert rows(spark.read.schema(first.schema).parquet(target).select("season", "week", "v")) == [(2000, 1, 2)]


def test_stream_raises_where_the_period_list_is_broken(spark, tmp_path):
    known = tmp_path / "known-periods"
    known.mkdir()
    (known / "part-0.parquet").write_bytes(b"not a table")
    source = new_folder(spark, "in")
    first = frame(spark, (1999, 1, 1))
    first.write.parquet(source)
    with pytest.raises(Exception):
        import_stream(spark, source, first.schema, first, new_folder(spark, "out"), str(tmp_path))
    assert (known / "part-0.parquet").read_bytes() == b"not a table"


def test_stream_drops_periods_that_are_delivered_again(spark):
    source, target, progress = (new_folder(spark, n) for n in ("in", "out", "progress"))
    first = frame(spark, (2000, 1, 1))
    first.coalesce(1).write.parquet(source)
    run = lambda: import_stream(spark, source, first.schema, first.limit(0), target, progress, "drop")
    run()
    run()
    frame(spark, (2000, 1, 1), (2000, 2, 2)).coalesce(1).write.mode("append").parquet(source)
    run()
    assert rows(spark.read.schema(first.schema).parquet(target).select("season", "week", "v")) == [(2000, 1, 1), (2000, 2, 2)]


def test_imports_take_every_season_the_table_has(spark):
    from pyspark.sql import functions as F

    from matchday.registry import Inputs, storage

    folder = "/root/testdata/sf0.001"
    later = Inputs(spark, folder)
    later.feed_games = later.feed_games.withColumn("season", F.col("season") + 10)
    later.feed_weekly = later.feed_weekly.withColumn("season", F.col("season") + 10)
    assert storage.src_bootstrap(later).count() == later.feed_games.count() > 0
    assert storage.src_incremental(later).count() == later.feed_weekly.where(f"NOT ({storage.STORED})").count() > 0


def test_csv_keeps_the_lines_that_do_not_fit(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,x,2.5\n2,y,oops\n3,z\nfour,x,1\n5,,\n6,x,1,7\n")
    rejects = str(tmp_path / "rejects")
    good, bad = feeds.read_csv_strictly(spark, str(tmp_path / "a.csv"), "a int, b string, c double", rejects)
    assert rows(good) == [(1, "x", 2.5), (5, None, None)]
    assert rows(bad) == rows(spark.read.parquet(rejects)) == [("2,y,oops",), ("3,z",), ("6,x,1,7",), ("four,x,1",)]


def test_appends_with_other_columns(spark, table):
    _, path = table
    sinks.append_evolving(spark.createDataFrame([(1, 2, "x")], "a int, b int, c string"), path)
    schema = sinks.append_evolving(spark.createDataFrame([(2**40, 0.5, True)], "a long, b double, d boolean"), path)
    assert [(f.name, f.dataType.simpleString()) for f in schema.fields] == [("a", "bigint"), ("b", "double"), ("c", "string"), ("d", "boolean")]
    with pytest.raises(ValueError, match="c is stored as string"):
        sinks.append_evolving(spark.createDataFrame([(1, 5)], "a int, c int"), path)
    assert rows(sinks.read_evolving(spark, path)) == [(1, 2.0, "x", None), (2**40, 0.5, None, True)]


def by_event_time(spark, deliveries, **more):
    """What is stored after each delivery, and how many rows came too late."""
    source, target, progress = (new_folder(spark, n) for n in ("in", "out", "progress"))
    found = []
    for delivery in deliveries:
        delivery.coalesce(1).write.mode("append").parquet(source)
        late = import_by_event_time(spark, source, delivery.schema, ["v"], target, progress, **more)
        found.append((rows(spark.read.schema(delivery.schema).parquet(target).select("season", "week", "v")), late))
    return found


def test_event_time_keeps_a_row_once_within_and_between_runs(spark):
    first, second = by_event_time(spark, [frame(spark, (2000, 1, 1), (2000, 1, 1), (2000, 2, 1)), frame(spark, (2000, 2, 1), (2000, 1, 2), (2000, 3, 1))])
    assert first == ([(2000, 1, 1), (2000, 2, 1)], 0)
    assert second == ([(2000, 1, 1), (2000, 1, 2), (2000, 2, 1), (2000, 3, 1)], 0)


def test_event_time_closes_periods_that_the_watermark_passed(spark):
    found = by_event_time(spark, [frame(spark, (2000, 1, 1), (2000, 6, 1)), frame(spark, (2000, 1, 1), (2000, 3, 7), (2000, 4, 7))], open_periods=2)
    # weeks 1 and 3 are more than two before week 6, delivered again or not
    assert found[1] == ([(2000, 1, 1), (2000, 4, 7), (2000, 6, 1)], 2)
    # the next season closes all of the last one, but not for the batch that brings it
    found = by_event_time(spark, [frame(spark, (2000, 21, 1)), frame(spark, (2000, 22, 1), (2001, 1, 1)), frame(spark, (2000, 22, 2))], open_periods=2)
    assert found[1] == ([(2000, 21, 1), (2000, 22, 1), (2001, 1, 1)], 0)
    assert found[2] == (found[1][0], 1)


def test_event_time_refuses_rows_without_a_period_and_tells_null_keys_apart(spark):
    kind = frame(spark, (2000, 1, 1)).schema
    odd = spark.createDataFrame([(2000, 1, None), (2000, 1, None), (2000, 2, None)], kind)
    assert by_event_time(spark, [odd])[0] == ([(2000, 1, None), (2000, 2, None)], 0)
    with pytest.raises(Exception, match="a row has no period"):
        by_event_time(spark, [spark.createDataFrame([(2000, None, 1)], kind)])
    assert by_event_time(spark, [frame(spark, (2000, 1, 1)), spark.createDataFrame([], kind)])[1] == ([(2000, 1, 1)], 0)
