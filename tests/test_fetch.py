from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys
import time

import pandas as pd
import pyarrow as pa
import pytest
from conftest import settings
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quoteloom import ContractError
from quoteloom.operators import fetch as f
from quoteloom.shared import land
from quoteloom.sources import function

SCHEMA = T.StructType([T.StructField("date", T.DateType()), T.StructField("close", T.DoubleType())])


def make_provider(bad=(), bad_from=None, indexed=False):
    def provider(key, start, end):
        if key in bad and (bad_from is None or start >= bad_from):
            raise ValueError(f"no data for {key}")
        end_day = end or dt.date(2024, 2, 1)
        days = pd.date_range(start, end_day, inclusive="left")
        frame = pd.DataFrame({"close": days.day * 1.0 + len(key), "extra": 1, "date": days.date})
        return frame.set_index("date") if indexed else frame

    return provider


@pytest.fixture
def worklist(spark):
    return spark.createDataFrame(
        [("A", dt.date(2024, 1, 1)), ("BB", dt.date(2024, 1, 20)), ("CCC", dt.date(2024, 1, 10))],
        "symbol string, start_date date",
    )


def expected(items, end):
    out = set()
    for key, first in items:
        day = first
        while day < end:
            out.add((key, day, float(day.day + len(key))))
            day += dt.timedelta(days=1)
    return out


def rows(df):
    return {(r["symbol"], r["date"], r["close"]) for r in df.collect()}


ITEMS = [("A", dt.date(2024, 1, 1)), ("BB", dt.date(2024, 1, 20)), ("CCC", dt.date(2024, 1, 10))]
RUN = dt.date(2024, 1, 25)


@pytest.mark.parametrize("max_parallel", [None, 1, 5])
def test_ranged_fetch_is_half_open_and_independent_of_parallelism(spark, worklist, max_parallel):
    got = f.fetch(worklist, make_provider(), SCHEMA, run_date=RUN, max_parallel=max_parallel)
    assert got.columns == ["date", "close", "symbol"]
    assert rows(got) == expected(ITEMS, RUN)
    assert got.count() == len(expected(ITEMS, RUN))


def test_open_ended_fetch_passes_no_end(spark, worklist):
    got = f.fetch(worklist, make_provider(), SCHEMA, open_ended=True)
    assert rows(got) == expected(ITEMS, dt.date(2024, 2, 1))


def test_text_start_dates_and_indexed_frames(spark):
    items = spark.createDataFrame([("A", "2024-01-20")], "symbol string, start_date string")
    got = f.fetch(items, make_provider(indexed=True), SCHEMA, run_date="2024-01-25")
    assert rows(got) == expected([("A", dt.date(2024, 1, 20))], RUN)


def test_period_worklist_reaches_back_whole_months(spark):
    keys = spark.createDataFrame([("A",)], "symbol string")
    got = f.period_worklist(keys, 1, "2024-03-31").first()
    assert (got.start_date, got.end_date) == (dt.date(2024, 2, 29), dt.date(2024, 3, 31))


def test_rows_outside_the_asked_range_are_cut(spark, worklist):
    """A service may send more days than asked, its end day included."""
    plain = make_provider()

    def generous(key, start, end):
        return plain(key, start - dt.timedelta(days=2), end and end + dt.timedelta(days=3))

    asked = {"run_date": RUN, "date": "date"}
    got = f.fetch(worklist, generous, SCHEMA, **asked)
    assert rows(got) == expected(ITEMS, RUN)
    pieces = f.split_ranges(worklist, 4, RUN)
    got = f.fetch(pieces, generous, SCHEMA, date="date")
    assert got.count() == len(expected(ITEMS, RUN)) and rows(got) == expected(ITEMS, RUN)
    got = f.fetch(worklist, generous, SCHEMA, open_ended=True, date="date")
    assert rows(got) == expected(ITEMS, dt.date(2024, 2, 1))


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York", None])
def test_zoned_days_keep_their_local_date(spark, worklist, zone):
    plain = make_provider()

    def zoned(key, start, end):
        frame = plain(key, start, end)
        frame["date"] = pd.to_datetime(frame["date"]).dt.tz_localize(zone)
        return frame.set_index("date")

    for asked in ({}, {"date": "date"}):
        got = f.fetch(worklist, zoned, SCHEMA, run_date=RUN, **asked)
        assert rows(got) == expected(ITEMS, RUN)


def test_failing_keys_fail_drop_or_route(spark, worklist):
    provider = make_provider(bad=["BB"])
    with pytest.raises(Exception, match="fetch failed for 'BB': no data for BB"):
        f.fetch(worklist, provider, SCHEMA, run_date=RUN).collect()
    others = [i for i in ITEMS if i[0] != "BB"]
    dropped = f.fetch(worklist, provider, SCHEMA, run_date=RUN, on_error="drop")
    assert rows(dropped) == expected(others, RUN)
    routed = land(f.fetch(worklist, provider, SCHEMA, run_date=RUN, on_error="route"), "t")
    assert rows(f.fetched_rows(routed)) == expected(others, RUN)
    assert [tuple(r) for r in f.fetch_errors(routed).collect()] == [("BB", "no data for BB")]


def test_a_value_of_another_type_fails_its_own_key_only(spark, worklist):
    plain = make_provider()

    def provider(key, start, end):
        frame = plain(key, start, end)
        if key == "BB":
            frame["close"] = "n/a"
        return frame

    routed = land(f.fetch(worklist, provider, SCHEMA, run_date=RUN, on_error="route"), "t")
    assert rows(f.fetched_rows(routed)) == expected([i for i in ITEMS if i[0] != "BB"], RUN)
    assert [r.symbol for r in f.fetch_errors(routed).collect()] == ["BB"]


def test_missing_numbers_and_all_types(spark, worklist):
    schema = T.StructType(
        [
            T.StructField("date", T.DateType()),
            T.StructField("n", T.LongType()),
            T.StructField("i", T.IntegerType()),
            T.StructField("x", T.FloatType()),
            T.StructField("s", T.StringType()),
            T.StructField("at", T.TimestampType()),
        ]
    )

    def provider(key, start, end):
        return pd.DataFrame(
            {
                "date": pd.to_datetime([start, start]),
                "n": [1.0, float("nan")],
                "i": [3, 4],
                "x": [0.5, None],
                "s": ["a", None],
                "at": pd.to_datetime(["2024-01-02 03:04:05.000006", None]),
            }
        )

    got = f.fetch(worklist.where("symbol = 'A'"), provider, schema, run_date=RUN).orderBy("i").collect()
    first = dt.datetime(2024, 1, 2, 3, 4, 5, 6)
    assert [tuple(r) for r in got] == [
        (dt.date(2024, 1, 1), 1, 3, 0.5, "a", first, "A"),
        (dt.date(2024, 1, 1), None, 4, None, None, None, "A"),
    ]


@pytest.mark.parametrize("asked", [{}, {"date": "date"}])
def test_providers_may_return_arrow_tables(spark, worklist, asked):
    plain = make_provider()

    def provider(key, start, end):
        return pa.Table.from_pandas(plain(key, start, end), preserve_index=False)

    got = f.fetch(worklist, provider, SCHEMA, run_date=RUN, **asked)
    assert rows(got) == expected(ITEMS, RUN)


def test_many_rows_leave_in_several_batches(spark, worklist):
    def provider(key, start, end):
        return pd.DataFrame({"date": [start] * 7_000, "close": range(7_000)}).astype({"close": float})

    got = f.fetch(worklist, provider, SCHEMA, run_date=RUN, max_parallel=1)
    assert got.groupBy("symbol").count().select("count").distinct().collect()[0][0] == 7_000
    assert got.count() == 21_000


def test_all_keys_failing_gives_only_errors(spark, worklist):
    provider = make_provider(bad=["A", "BB", "CCC"])
    routed = f.fetch(worklist, provider, SCHEMA, run_date=RUN, on_error="route")
    assert f.fetch_errors(routed).count() == 3
    assert f.fetch(worklist, provider, SCHEMA, run_date=RUN, on_error="drop").count() == 0


def test_empty_worklist_and_up_to_date_keys(spark, worklist):
    nothing = f.fetch(worklist.limit(0), make_provider(), SCHEMA, run_date=RUN)
    assert nothing.count() == 0 and nothing.columns == ["date", "close", "symbol"]
    late = worklist.withColumn("start_date", F.lit(RUN))
    assert f.fetch(late, make_provider(), SCHEMA, run_date=RUN).count() == 0


def test_a_missing_source_column_is_an_error(spark, worklist):
    wide = T.StructType([*SCHEMA.fields, T.StructField("adj", T.DoubleType())])
    with pytest.raises(Exception, match="adj"):
        f.fetch(worklist, make_provider(), wide, run_date=RUN).collect()


def test_arguments_are_checked(spark, worklist):
    with pytest.raises(ValueError, match="on_error"):
        f.fetch(worklist, make_provider(), SCHEMA, on_error="ignore")
    with pytest.raises(ContractError, match="start_date"):
        f.fetch(worklist.drop("start_date"), make_provider(), SCHEMA)


@pytest.mark.parametrize("max_days", [1, 4, 7, 400])
def test_split_ranges_cover_each_range_exactly(spark, worklist, max_days):
    pieces = f.split_ranges(worklist, max_days, RUN)
    for r in pieces.collect():
        assert 0 < (r.end_date - r.start_date).days <= max_days
    assert rows(f.fetch(pieces, make_provider(), SCHEMA)) == expected(ITEMS, RUN)
    assert f.fetch(pieces, make_provider(), SCHEMA).count() == len(expected(ITEMS, RUN))


def test_one_failed_piece_takes_the_whole_key_out(spark, worklist):
    provider = make_provider(bad=["A"], bad_from=dt.date(2024, 1, 9))
    pieces = f.split_ranges(worklist, 4, RUN)
    landed = land(f.fetch(pieces, provider, SCHEMA, on_error="route"), "t")
    assert f.fetched_rows(landed).where("symbol = 'A'").count() > 0
    assert rows(f.whole_keys_only(landed)) == expected(ITEMS[1:], RUN)


def test_a_hot_key_is_spread_over_tasks(spark):
    items = spark.createDataFrame([("A", dt.date(2000, 1, 1))], "symbol string, start_date date")
    pieces = f.split_ranges(items, 100, RUN)
    used = (
        f.distribute(pieces, 16).groupBy(F.spark_partition_id().alias("task")).count().collect()
    )
    assert len(used) > 8


def test_pause_waits_after_each_call(spark, worklist):
    began = time.time()
    f.fetch(
        worklist, make_provider(), SCHEMA, run_date=RUN, max_parallel=1, pause=(0.3, 0.4)
    ).collect()
    assert time.time() - began >= 0.9


def test_range_filter_is_the_set_form(spark, worklist):
    table = f.fetch(
        worklist.withColumn("start_date", F.lit(dt.date(2023, 12, 20))),
        make_provider(),
        SCHEMA,
        run_date="2024-02-10",
    )
    assert rows(f.range_filter(table, worklist, RUN)) == expected(ITEMS, RUN)
    # a key listed twice does not double its rows
    twice = worklist.union(worklist)
    assert f.range_filter(table, twice, RUN).count() == len(expected(ITEMS, RUN))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_range_filter_with_one_hot_symbol(spark, threshold):
    days = F.expr("date_add(DATE '2024-01-01', CAST(id % 60 AS INT))")
    symbol = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 500))
    table = spark.range(30_000).select(symbol.alias("symbol"), days.alias("date"), "id")
    items = table.select("symbol").distinct().withColumn(
        "start_date", F.when(F.col("symbol") == "HOT", F.lit(dt.date(2024, 1, 5))).otherwise(
            F.lit(dt.date(2024, 2, 1))
        )
    )
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": threshold}):
        got = f.range_filter(table, items, "2024-02-20")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (threshold != "-1")
        got = got.toPandas()
    all_rows = table.toPandas()
    first = all_rows.symbol.map(lambda s: dt.date(2024, 1, 5) if s == "HOT" else dt.date(2024, 2, 1))
    want = all_rows[(all_rows.date >= first) & (all_rows.date < dt.date(2024, 2, 20))]
    assert sorted(got.id) == sorted(want.id)


def test_fetch_as_a_table_function(spark, worklist):
    plain = make_provider()

    def zoned(key, start, end):
        frame = plain(key, start, end and end + dt.timedelta(days=2))
        frame["date"] = pd.to_datetime(frame["date"]).dt.tz_localize("Asia/Tokyo")
        return frame.set_index("date")

    def call(name, items):
        return spark.sql(f"SELECT * FROM {name}(TABLE({{items}}))", items=f.distribute(items, 3))

    late = worklist.union(spark.createDataFrame([("LATE", RUN)], worklist.schema))
    function.register_fetch_function(spark, "test_feed", zoned, SCHEMA, date="date")
    assert rows(call("test_feed", f.due_items(late, "2024-01-25"))) == expected(ITEMS, RUN)
    pieces = f.due_items(f.split_ranges(late, 2, "2024-01-25"))
    assert rows(call("test_feed", pieces)) == expected(ITEMS, RUN)
    endless = call("test_feed", f.due_items(late, open_ended=True))
    assert {r.symbol for r in endless.collect()} == {"A", "BB", "CCC", "LATE"}
    bad = make_provider(bad=["BB"])
    function.register_fetch_function(spark, "test_bad", bad, SCHEMA)
    with pytest.raises(Exception, match="no data for BB"):
        call("test_bad", f.due_items(late, "2024-01-25")).collect()
    function.register_fetch_function(spark, "test_routed", bad, SCHEMA, on_error="route")
    routed = call("test_routed", f.due_items(late, "2024-01-25"))
    assert [tuple(r) for r in f.fetch_errors(routed).collect()] == [("BB", "no data for BB")]
    with pytest.raises(ContractError, match="flag"):
        flagged = T.StructType([T.StructField("flag", T.BooleanType())])
        function.register_fetch_function(spark, "test_flag", plain, flagged)


def test_split_keeps_items_without_start_or_end(spark):
    schema = "symbol string, start_date date, end_date date"
    day = lambda n: dt.date(2024, 1, n)
    items = [("A", day(1), None), ("B", None, day(5)), ("C", day(3), day(6)), ("D", day(9), None), ("E", day(5), day(5))]
    got = f.split_ranges(spark.createDataFrame(items, schema), 2, "2024-01-04")
    assert {tuple(r) for r in got.collect()} == {
        ("A", day(1), day(3)), ("A", day(3), day(4)), ("A", day(4), None),
        ("B", None, day(5)),
        ("C", day(3), day(5)), ("C", day(5), day(6)),
        ("D", day(9), None),
    }
    routed = f.fetch(got.where("symbol = 'B'"), make_provider(), SCHEMA, on_error="route")
    assert [tuple(r) for r in f.fetch_errors(routed).collect()] == [("B", "no start date")]
    with pytest.raises(Exception, match="no start date"):
        f.fetch(got.where("symbol = 'B'"), make_provider(), SCHEMA).collect()


def test_one_new_key_leaves_the_bound_of_the_others(spark):
    table = spark.range(400).selectExpr(
        "concat('S', id % 4) AS symbol", "date_add(DATE '2024-01-01', CAST(id / 4 AS INT)) AS date", "id"
    )
    starts = [("S0", "2023-12-01"), ("S1", "2024-03-01"), ("S2", "2024-03-05"), ("S3", "2024-09-09")]
    items = spark.createDataFrame(starts, "symbol string, start_date string")
    got = f.due_rows(table, items, "2024-01-01", "2024-04-01")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-03-01" in plan and "2023-12-01" in plan
    want = [r.id for r in table.collect() if dict(starts)[r.symbol] <= str(r.date) < "2024-04-01"]
    assert sorted(r.id for r in got.collect()) == sorted(want)


def test_tasks_do_not_need_the_library_installed(tmp_path):
    """Providers and fetch code travel with the job, so a driver anywhere will do."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "job.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "from pyspark.sql import SparkSession\n"
        "import __spark_entry__ as e\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        f".config('spark.sql.warehouse.dir', {str(tmp_path / 'wh')!r})"
        ".config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "print('ROWS', e.entry(s).count())\n"
        "print('ROWS', e.queries()['q_datasource'](s, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    counts = [int(line.split()[1]) for line in done.stdout.splitlines() if line.startswith("ROWS")]
    assert len(counts) == 2 and counts[0] == counts[1] > 0, done.stderr[-2000:]
