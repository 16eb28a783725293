from __future__ import annotations

import datetime as dt
import re
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import settings

from quoteloom import Contract, ContractError, LoadError
from quoteloom.plans import standin
from quoteloom.plans.loading import load_raw, publish
from quoteloom.shared import land
from quoteloom.sinks import jdbc as jdbc_sink
from quoteloom.sinks import tables as sink
from quoteloom.sources import jdbc as jdbc_source
from quoteloom.sources import tables as source

SCHEMA = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
    ]
)
SPEC = {
    "schema": [
        {"name": "date", "type": "DateType", "nullable": False, "source": "Date"},
        {"name": "close", "type": "DoubleType", "source": "Close"},
        {"name": "volume", "type": "IntegerType", "source": "Volume"},
        {"name": "symbol", "type": "StringType", "nullable": False},
        {"name": "import_time", "type": "TimestampType", "nullable": False},
    ],
    "keys": ["symbol", "date"],
}
D = dt.date


def make_provider(bad=(), volume=100, shift=0.0):
    def provider(key, start, end):
        if key in bad:
            raise ValueError(f"no data for {key}")
        days = [start + dt.timedelta(days=i) for i in range((end - start).days)]
        return pd.DataFrame(
            {"Date": days, "Close": [d.day + shift for d in days], "Volume": volume}
        )

    return provider


@pytest.fixture
def namespace(spark):
    return standin.new_namespace(spark)


@pytest.fixture
def contract(namespace):
    return Contract.from_spec(f"{namespace}.quotes", SPEC)


def items(spark, start=D(2024, 1, 1), keys=("A", "B")):
    return spark.createDataFrame([(k, start) for k in keys], "symbol string, start_date date")


def load(spark, contract, provider, start=D(2024, 1, 1), end=D(2024, 1, 4), **kw):
    return load_raw(
        spark, items(spark, start), provider, SCHEMA, contract,
        run_date=end, stamp="2024-01-04T06:00:00", **kw,
    )


def content(spark, table):
    return sorted((r.symbol, r.date, r.close) for r in source.scan(spark, table).collect())


def days(key, first, n, shift=0.0):
    return [(key, D(2024, 1, first + i), first + i + shift) for i in range(n)]


# ---- raw load ----------------------------------------------------------------------------


@pytest.mark.parametrize("partition_by", [(), ("date",)])
def test_load_overwrites_and_reports(spark, contract, partition_by):
    contract = contract.partitioned_by(*partition_by)
    report = load(spark, contract, make_provider())
    assert (report.rows_in, report.rows_written, report.rows_rejected, report.calls_failed) == (6, 6, 0, 0)
    assert content(spark, contract.table) == days("A", 1, 3) + days("B", 1, 3)
    load(spark, contract, make_provider(shift=0.5), start=D(2024, 1, 3))
    assert content(spark, contract.table) == days("A", 3, 1, 0.5) + days("B", 3, 1, 0.5)
    assert source.partition_columns(spark, contract.table) == list(partition_by)
    assert source.scan(spark, contract.table).columns[-1] == (partition_by or ["import_time"])[0]


def test_load_keeps_going_without_the_failing_key(spark, contract):
    report = load(spark, contract, make_provider(bad=["B"]))
    assert report.calls_failed == 1 and report.rows_written == 3
    assert [tuple(r) for r in report.errors.collect()] == [("B", "no data for B")]
    assert content(spark, contract.table) == days("A", 1, 3)


def test_load_with_pieces(spark, contract):
    report = load(spark, contract, make_provider(), max_days=1)
    assert report.rows_written == 6
    report = load(spark, contract, make_provider(bad=["A"]), max_days=1)
    assert report.calls_failed == 3 and content(spark, contract.table) == days("B", 1, 3)


def test_withheld_rows_are_reported(spark, contract):
    plain = make_provider()

    def provider(key, start, end):
        if key == "A" and start == D(2024, 1, 2):
            raise ValueError("no data")
        return plain(key, start, end)

    report = load(spark, contract, provider, max_days=1)
    assert (report.rows_in, report.rows_written, report.rows_withheld) == (5, 3, 2)
    assert {r.symbol for r in report.withheld.collect()} == {"A"}
    with pytest.raises(LoadError, match="1 failed calls"):
        load(spark, contract, provider, max_days=1, max_failed=0)
    report.clear()


def test_load_takes_other_names_and_open_ends(spark, namespace):
    spec = {**SPEC, "schema": [{**f, "name": "ticker"} if f["name"] == "symbol" else f for f in SPEC["schema"]]}
    spec["keys"] = ["ticker", "date"]
    contract = Contract.from_spec(f"{namespace}.tickers", spec)
    plain = make_provider()
    wanted = spark.createDataFrame([("A", D(2024, 1, 1))], "ticker string, since date")
    report = load_raw(
        spark, wanted, lambda k, lo, hi: plain(k, lo, hi or D(2024, 1, 9)), SCHEMA, contract,
        run_date=D(2024, 1, 4), key="ticker", start="since", open_ended=True,
    )
    assert report.rows_written == 8


def test_a_long_range_is_many_calls_in_many_tasks(spark, contract):
    from pyspark import TaskContext

    def provider(key, start, end):
        here = TaskContext.get().partitionId()
        return pd.DataFrame({"Date": [start], "Close": [float(here)], "Volume": [(end - start).days]})

    load(spark, contract, provider, start=D(1994, 1, 1))
    calls = source.scan(spark, contract.table).where("symbol = 'A'").collect()
    assert len(calls) == 30 and max(r.volume for r in calls) <= 366
    assert len({r.close for r in calls}) > 5


def test_failed_batches_leave_the_table_alone(spark, contract):
    load(spark, contract, make_provider())
    before = content(spark, contract.table)
    with pytest.raises(LoadError, match="2 failed calls"):
        load(spark, contract, make_provider(bad=["A", "B"]))
    with pytest.raises(Exception, match="fetch failed for 'A'"):
        load(spark, contract, make_provider(bad=["A"]), on_error="fail")
    with pytest.raises(LoadError, match="all 6 rows"):
        load(spark, contract, make_provider(volume=2**31))
    # no new rows is not a failure and does not empty the table
    report = load(spark, contract, make_provider(), start=D(2024, 1, 4))
    assert (report.rows_in, report.rows_written) == (0, 0)
    assert content(spark, contract.table) == before
    load(spark, contract, make_provider(), start=D(2024, 1, 4), allow_empty=True)
    assert content(spark, contract.table) == []


def test_bad_values_reject_rows_and_not_the_job(spark, contract):
    plain = make_provider()

    def provider(key, start, end):
        frame = plain(key, start, end)
        frame.loc[0, "Volume"] = 2**31
        return frame

    report = load(spark, contract, provider)
    assert (report.rows_in, report.rows_written, report.rows_rejected) == (6, 4, 2)
    assert {tuple(r.violations) for r in report.rejects.collect()} == {("volume: not IntegerType",)}
    with pytest.raises(LoadError, match="2 of 6"):
        load(spark, contract, provider, strict=True)


def test_load_modes(spark, contract):
    load(spark, contract, make_provider())
    load(spark, contract, make_provider(), start=D(2024, 1, 4), end=D(2024, 1, 5), mode="append")
    assert content(spark, contract.table) == days("A", 1, 4) + days("B", 1, 4)
    with pytest.raises(LoadError, match="not partitioned"):
        load(spark, contract, make_provider(), mode="partitions")
    for bad in ({"mode": "truncate"}, {"on_error": "drop"}):
        with pytest.raises(ValueError):
            load(spark, contract, make_provider(), **bad)


def test_the_fetch_runs_once(spark, contract, tmp_path):
    calls = str(tmp_path / "calls")
    plain = make_provider()

    def provider(key, start, end):
        with open(calls, "a") as f:
            f.write(f"{key}\n")
        return plain(key, start, end)

    load(spark, contract, provider)
    with open(calls) as f:
        assert sorted(f.read().split()) == ["A", "B"]


# ---- table sinks ---------------------------------------------------------------------------


def frame(spark, rows, schema="k int, v int, p string"):
    return spark.createDataFrame(rows, schema).coalesce(1)


def table_rows(spark, name):
    return sorted((r.k, r.v, r.p) for r in source.scan(spark, name).collect())


@pytest.mark.parametrize("partition_by", [[], ["p"], ["p", "v"]])
def test_overwrite_may_read_the_table_it_replaces(spark, namespace, partition_by):
    name = f"{namespace}.t"
    sink.write_overwrite(frame(spark, [(1, 1, "x"), (2, 2, "y")]), name, partition_by=partition_by)
    for _ in range(2):
        sink.write_overwrite(source.scan(spark, name).where("p = 'y'").withColumn("k", F.col("k") + 1), name)
    assert table_rows(spark, name) == [(4, 2, "y")]
    assert source.partition_columns(spark, name) == partition_by
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {namespace}").collect()] == ["t"]


def test_overwrite_failing_midway_keeps_the_old_table(spark, namespace):
    name = f"{namespace}.t"
    sink.write_overwrite(frame(spark, [(1, 1, "x")]), name)
    broken = frame(spark, [(1, 0, "x")]).withColumn("v", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        sink.write_overwrite(broken, name)
    assert table_rows(spark, name) == [(1, 1, "x")]
    sink.write_overwrite(frame(spark, [(2, 2, "z")]), name)
    assert table_rows(spark, name) == [(2, 2, "z")]


class BreakingSession:
    """A session of which the n-th statement that changes the catalog breaks."""

    def __init__(self, session, at):
        self.session, self.at = session, at

    def sql(self, text, *args, **kwargs):
        if text.split()[0] in ("CREATE", "ALTER", "DROP"):
            self.at -= 1
            if self.at == 0:
                raise RuntimeError("lost")
        return self.session.sql(text, *args, **kwargs)

    def __getattr__(self, name):
        return getattr(self.session, name)


def breaks_at(monkeypatch, step, work):
    """Run ``work`` with a break at its ``step``-th statement; whether there was one."""
    replace, switch = sink._replace, sink._switch

    def begin(rows, *args, **kwargs):
        session = BreakingSession(rows.sparkSession, step)
        with monkeypatch.context() as patch:
            patch.setattr(type(rows), "sparkSession", property(lambda _: session), raising=False)
            patch.setattr(sink, "_switch", lambda _, *a: switch(session, *a))
            return replace(rows, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(sink, "_replace", begin)
        try:
            work()
        except RuntimeError as e:
            assert "lost" in str(e)
            return True
    return False


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_a_replacement_may_break_at_any_statement(spark, namespace, monkeypatch, partition_by):
    x, y, z = (1, 1, "x"), (2, 2, "y"), (3, 3, "x")
    works = {
        "overwrite": lambda name: sink.write_overwrite(frame(spark, [y, z]), name),
        "merge": lambda name: sink.merge_into(frame(spark, [y, z]), name, ["k", "p"]),
    }
    if partition_by:
        works["partitions"] = lambda name: sink.write_partitions(frame(spark, [y, z]), name)
    for what, work in works.items():
        old, new = [x], sorted([x, y, z] if what == "merge" else [y, z])
        for step in range(1, 20):
            name = f"{namespace}.{what}{step}"
            sink.write_overwrite(frame(spark, old), name, partition_by=partition_by)
            broke = breaks_at(monkeypatch, step, lambda: work(name))
            rows = table_rows(spark, name)
            # a partition at a time is new; none is ever in between
            for p in "xy":
                assert [r for r in rows if r[2] == p] in ([r for r in some if r[2] == p] for some in (old, new))
            if not partition_by:
                assert rows in (old, new)
            sink.recover(spark, name)
            assert table_rows(spark, name) == (old if broke and step <= 2 else new)
            if step > 4 and broke:
                continue
            sink.write_append(frame(spark, [(9, 9, "q")]), name)
            work(name)
            kept = [(9, 9, "q")] if what != "overwrite" else []
            assert table_rows(spark, name) == sorted([*new, *kept])
            if not broke:
                break
        assert step > 3 and not broke
    listed = {r.tableName for r in spark.sql(f"SHOW TABLES IN {namespace}").collect()}
    assert not [t for t in listed if t.endswith("__pending")]


def test_a_load_after_a_broken_one_keeps_every_row(spark, contract, monkeypatch):
    for step in (2, 3):
        load(spark, contract, make_provider())
        broke = breaks_at(monkeypatch, step, lambda: load(spark, contract, make_provider(shift=0.5)))
        # up to date: nothing to write, but what was pending is done
        load(spark, contract, make_provider(), start=D(2024, 1, 4))
        shift = 0 if broke and step <= 2 else 0.5
        assert content(spark, contract.table) == days("A", 1, 3, shift) + days("B", 1, 3, shift)


def test_a_broken_change_of_shape_is_finished(spark, namespace, monkeypatch):
    for step in range(1, 10):
        name = f"{namespace}.t{step}"
        sink.write_overwrite(frame(spark, [(1, 1, "x")]), name)
        new = frame(spark, [(2, 2, "y")]).drop("v")
        broke = breaks_at(monkeypatch, step, lambda: sink.write_replace(new, name, "orc", ["p"]))
        sink.recover(spark, name)
        if broke and step <= 2:
            assert table_rows(spark, name) == [(1, 1, "x")]
        else:
            assert [tuple(r) for r in source.scan(spark, name).collect()] == [(2, "y")]
            assert source.partition_columns(spark, name) == ["p"]
        if not broke:
            break
    assert step > 4 and not broke


def files_below(folder):
    import glob

    return sorted(f for f in glob.glob(f"{folder}/**/*.parquet", recursive=True) if "/_" not in f)


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_rows_are_written_once_and_readers_see_whole_tables(spark, tmp_path, partition_by):
    space = f"once_{uuid.uuid4().hex}"
    sink.create_namespace(spark, space, f"file://{tmp_path}/space")
    name = f"{space}.t"
    sink.write_overwrite(frame(spark, [(1, 1, "x"), (2, 2, "y")]), name, partition_by=partition_by)
    first = files_below(tmp_path)
    assert len(first) == (2 if partition_by else 1)
    began = source.scan(spark, name).where("k > 0")
    assert began.count() == 2
    sink.write_overwrite(frame(spark, [(5, 5, "x")]), name)
    assert len(files_below(tmp_path)) == len(first) + 1
    # a query that was planned before the switch still finds its files
    assert sorted((r.k, r.v, r.p) for r in began.collect()) in ([(1, 1, "x"), (2, 2, "y")], [(5, 5, "x")])
    assert table_rows(spark, name) == [(5, 5, "x")]
    # what the last replacement but one left is gone
    sink.write_overwrite(frame(spark, [(6, 6, "z")]), name)
    assert not set(first) & set(files_below(tmp_path))
    assert len(files_below(tmp_path)) == 2
    sink.write_append(frame(spark, [(7, 7, "x")]), name)
    assert table_rows(spark, name) == [(6, 6, "z"), (7, 7, "x")]
    assert len(files_below(tmp_path)) == 2


def test_odd_partition_values_are_switched(spark, namespace):
    name = f"{namespace}.t"
    odd = ["a/b é=1", "it's", "50%", "", None, "null", "x y:z", "back\\slash"]
    sink.write_overwrite(frame(spark, [(k, 1, p) for k, p in enumerate(odd)]), name, partition_by=["p"])
    sink.write_partitions(frame(spark, [(k, 2, p) for k, p in enumerate(odd)]), name)
    # an empty text is a null as a partition value, so says Spark
    want = sorted((k, 2, p or None) for k, p in enumerate(odd))
    got = sorted((r.k, r.v, r.p) for r in source.scan(spark, name).collect())
    assert got == want
    sink.write_overwrite(frame(spark, [(1, 3, "it's")]), name)
    assert table_rows(spark, name) == [(1, 3, "it's")]


@pytest.mark.parametrize("partitioned", ["", "PARTITIONED BY (p)"])
def test_overwrite_and_merge_keep_the_definition(spark, namespace, tmp_path, partitioned):
    name = f"{namespace}.t"
    spark.sql(
        f"CREATE TABLE {name} (k BIGINT, v DOUBLE, p STRING) USING orc {partitioned} LOCATION '{tmp_path}/place'"
    )

    def definition():
        shown = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        return [shown[c] for c in ("k", "v", "p", "Provider", "Type")]

    before = definition()
    sink.write_overwrite(frame(spark, [(1, 1, "x"), (2, 2, "y")]), name)
    sink.merge_into(frame(spark, [(2, 5, "y")]), name, ["k", "p"])
    assert definition() == before and "orc" in before and "EXTERNAL" in before
    assert table_rows(spark, name) == [(1, 1.0, "x"), (2, 5.0, "y")]
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        wide = spark.sql("SELECT 1 AS k, 2L AS v, 'x' AS p").withColumn("k", F.lit("9" * 30).cast("decimal(38,0)"))
        sink.write_overwrite(wide, name)
    assert len(table_rows(spark, name)) == 2


def test_extra_columns_are_refused(spark, namespace):
    name = f"{namespace}.t"
    sink.write_overwrite(frame(spark, [(1, 2, "x")]), name, partition_by=["p"])
    more = frame(spark, [(4, 5, "y")]).withColumn("extra", F.lit(1))
    for write in (sink.write_append, sink.write_partitions, sink.write_overwrite):
        with pytest.raises(ContractError, match="extra"):
            write(more, name)
    sink.write_append(more, name, drop_extra=True)
    assert table_rows(spark, name) == [(1, 2, "x"), (4, 5, "y")]


def test_append_goes_by_name(spark, namespace):
    name = f"{namespace}.t"
    sink.write_overwrite(frame(spark, [(1, 2, "x")]), name, partition_by=["p"])
    sink.write_append(frame(spark, [("y", 5, 4)], "p string, v int, k int"), name)
    assert table_rows(spark, name) == [(1, 2, "x"), (4, 5, "y")]
    with pytest.raises(ContractError, match="lacks"):
        sink.write_append(frame(spark, [(4, 5)], "k int, v int"), name)


def test_partition_overwrite_touches_only_its_partitions(spark, namespace):
    name = f"{namespace}.t"
    sink.write_overwrite(frame(spark, [(1, 1, "x"), (2, 2, "y")]), name, partition_by=["p"])
    setting = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    sink.write_partitions(frame(spark, [(3, 3, "y"), (4, 4, "z")]), name)
    assert table_rows(spark, name) == [(1, 1, "x"), (3, 3, "y"), (4, 4, "z")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == setting


@pytest.mark.parametrize(
    ("keys", "partition_by"),
    [
        (["k"], []),
        (["k"], ["p"]),
        (["k", "p"], ["p"]),
        (["k"], ["p", "v"]),
        (["k", "p", "v"], ["p", "v"]),
    ],
)
def test_merge_is_the_same_for_every_layout(spark, namespace, keys, partition_by):
    name = f"{namespace}.t"
    old = [(k, k % 3, "xyz"[k % 3]) for k in range(9)]
    new = [(k, 7, "xyz"[k % 3]) for k in range(5, 8)] + [(20, 7, "w"), (0, 0, "x")]
    sink.write_overwrite(frame(spark, old), name, partition_by=partition_by)
    at = ["kvp".index(c) for c in keys]
    pick = {tuple(r[i] for i in at): r for r in old}
    pick.update({tuple(r[i] for i in at): r for r in new})
    for _ in range(2):
        sink.merge_into(frame(spark, new), name, keys)
        assert table_rows(spark, name) == sorted(pick.values())


def test_merge_rewrites_only_touched_partitions(spark, namespace):
    name = f"{namespace}.t"
    rows = [(k, k, p) for k, p in enumerate("abcdefgh")]
    sink.write_overwrite(frame(spark, rows), name, partition_by=["p"])
    files = lambda p: sorted(
        r[0] for r in source.scan(spark, name).where(F.col("p") == p).select(F.input_file_name()).collect()
    )
    before = {p: files(p) for p in "abcdefgh"}
    sink.merge_into(frame(spark, [(2, 99, "c")]), name, ["k", "p"])
    assert [p for p in "abcdefgh" if files(p) != before[p]] == ["c"]


def test_merge_prunes_the_target_by_range_and_at_run_time(spark, namespace):
    name = f"{namespace}.t"
    rows = [(k, k, p) for k, p in enumerate("abcdefgh")]
    sink.write_overwrite(frame(spark, rows), name, partition_by=["p"])
    batch = [(2, 99, "c"), (3, 98, "d"), (9, 97, "z")]
    landed = land(frame(spark, batch), "batch")
    touched = sink.touched_partitions(source.scan(spark, name), landed, ["p"])
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "(p" in plan and ">= c)" in plan and "<= z)" in plan and "dynamicpruning" in plan.lower()
    sink.merge_into(frame(spark, batch), name, ["k", "p"])
    want = {**{(k, p): (k, v, p) for k, v, p in rows}, (2, "c"): (2, 99, "c"), (3, "d"): (3, 98, "d")}
    assert table_rows(spark, name) == sorted([*want.values(), (9, 97, "z")])


def test_merge_rewrites_only_touched_buckets(spark, namespace):
    name = f"{namespace}.t"
    spec = {
        "schema": [{"name": "k", "type": "LongType"}, {"name": "v", "type": "IntegerType"}, {"name": "p", "type": "StringType"}],
        "keys": ["k"],
    }
    contract = Contract.from_spec(name, spec)
    sink.create_bucketed_table(spark, contract, buckets=8, tasks=2)
    rows = [(k, 0, "x") for k in range(200)]
    sink.write_append(frame(spark, rows), name)

    def files():
        listed = source.scan(spark, name).select("bucket", F.input_file_name()).distinct().collect()
        return {b: {f for c, f in listed if c == b} for b in range(8)}

    before = files()
    # keys come as int, the table has long: the bucket is that of the long
    batch = frame(spark, [(7, 1, "y"), (900, 1, "y")])
    sink.merge_into(batch, name, ["k"])
    assert table_rows(spark, name) == sorted([*[r for r in rows if r[0] != 7], (7, 1, "y"), (900, 1, "y")])
    after = files()
    touched = {r.bucket for r in source.scan(spark, name).where("v = 1").collect()}
    assert len(touched) <= 2 and {b for b in range(8) if before[b] != after[b]} == touched
    assert all(len(after[b]) <= 2 for b in touched)
    sink.merge_into(batch, name, ["k"])
    sink.merge_into(frame(spark, [(7, 2, "z")]), name, ["k", "p"])
    assert sorted(r.v for r in source.scan(spark, name).where("k = 7").collect()) == [1, 2]

    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        target, rows = source.scan(spark, name), sink._in_table_order(batch, name)
        plan = sink.merged_buckets(target, rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    old, new = plan.split("Join", 1)[1].split("FileScan")[0], plan.split("FileScan")[1]
    assert "Exchange" not in old and "Exchange" in new and "SelectedBucketsCount: 2 out of 2" in plan
    with pytest.raises(ContractError, match="needs keys"):
        sink.create_bucketed_table(spark, contract.partitioned_by("p"), 8, 2)


@pytest.mark.parametrize("batch", [[(3, 3, None)], [(3, 3, None), (4, 4, "y")], []])
def test_null_partitions_survive_a_merge(spark, namespace, batch):
    name = f"{namespace}.t"
    old = [(1, 1, None), (2, 2, "y")]
    sink.write_overwrite(frame(spark, old), name, partition_by=["p"])
    sink.merge_into(frame(spark, batch), name, ["k", "p"])
    got = {(r.k, r.v, r.p) for r in source.scan(spark, name).collect()}
    assert got == {*old, *batch}


def test_merge_refuses_a_source_with_repeated_keys(spark, namespace):
    name = f"{namespace}.t"
    sink.write_overwrite(frame(spark, [(1, 1, "x")]), name)
    with pytest.raises(LoadError, match="more than once"):
        sink.merge_into(frame(spark, [(1, 2, "x"), (1, 3, "x")]), name, ["k"])
    assert table_rows(spark, name) == [(1, 1, "x")]
    sink.merge_into(
        frame(spark, [(1, 2, "x"), (1, 3, "x")]), name, ["k"], keep_first_by=[F.desc("v")]
    )
    assert table_rows(spark, name) == [(1, 3, "x")]


# ---- pluggable catalogs --------------------------------------------------------------------


def test_pluggable_catalog_uses_its_own_calls(spark, tmp_path):
    """On a catalog that ships with Spark; it has no MERGE, and says so after resolving ours."""
    catalog = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"
    spark.conf.set("spark.sql.catalog.db", catalog)
    spark.conf.set("spark.sql.catalog.db.url", f"jdbc:derby:{tmp_path}/db;create=true")
    spark.conf.set("spark.sql.catalog.db.driver", "org.apache.derby.jdbc.EmbeddedDriver")
    spec = {"schema": [{"name": "k", "type": "LongType"}, {"name": "v", "type": "DoubleType"}]}
    contract = Contract.from_spec("db.APP.t", spec)
    assert source.uses_v2_catalog(spark, "db.APP.t")
    assert not source.uses_v2_catalog(spark, "app.t") and not source.uses_v2_catalog(spark, "t")
    sink.create_table(spark, contract)
    sink.create_table(spark, contract)
    rows = spark.range(5).selectExpr("CAST(id * 1.5 AS DOUBLE) AS v", "id AS k")
    sink.write_append(rows, contract.table)
    assert {tuple(r) for r in source.scan(spark, contract.table).collect()} == {
        (k, k * 1.5) for k in range(5)
    }
    with pytest.raises(Exception, match="does not support MERGE"):
        sink.merge_into(rows, contract.table, ["k"])
    sink.write_overwrite(rows.where("k > 2"), contract.table)
    assert source.sql_count(spark, contract.table).first().n_rows == 2


# ---- relational database -------------------------------------------------------------------


@pytest.fixture
def database(spark):
    return standin.database(spark)


def name_of(label):
    return f"{label}_{uuid.uuid4().hex[:10]}"


def test_jdbc_filters_and_counts_reach_the_database(spark, database):
    url, options = database
    name = name_of("t")
    jdbc_sink.jdbc_append(frame(spark, [(1, 1, "x"), (2, 2, "y")]), url, name, options, column_types="p VARCHAR(8)")
    df = jdbc_source.jdbc_table(spark, url, name, options)
    plan = df.where("k > 1").select("v")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(k), *GreaterThan(k,1)]" in plan
    assert "ReadSchema: struct<v:int>" in plan
    assert jdbc_source.jdbc_count(spark, url, name, options) == 2


def test_jdbc_split_read_is_whole(spark, database):
    url, options = database
    name = name_of("t")
    jdbc_sink.jdbc_append(spark.range(100).selectExpr("id AS k", "id % 7 AS v"), url, name, options)
    df = jdbc_source.jdbc_table(spark, url, name, options, split_on="k", num_partitions=5)
    assert df.rdd.getNumPartitions() == 5
    assert sorted(r.k for r in df.collect()) == list(range(100))
    jdbc_sink.jdbc_replace(spark.range(0).selectExpr("id AS k", "id AS v"), url, name, options)
    assert jdbc_source.jdbc_table(spark, url, name, options, split_on="k").count() == 0


def test_publish_twice_changes_nothing_and_merges_overlaps(spark, contract, database):
    url, options = database
    stage, final = name_of("stage"), name_of("final")

    def send():
        return publish(
            spark, contract.table, url, stage, final, ["symbol", "date"], options,
            column_types="symbol VARCHAR(16)", num_partitions=2,
        )

    def finals():
        return sorted(
            (r.symbol, r.date, r.close) for r in jdbc_source.jdbc_table(spark, url, final, options).collect()
        )

    load(spark, contract, make_provider())
    assert send() == 6 and send() == 6
    assert finals() == days("A", 1, 3) + days("B", 1, 3)
    load(spark, contract, make_provider(shift=0.5), start=D(2024, 1, 3), end=D(2024, 1, 5))
    assert send() == 4 and send() == 4
    assert finals() == days("A", 1, 2) + days("A", 3, 2, 0.5) + days("B", 1, 2) + days("B", 3, 2, 0.5)


class Breaking:
    """A statement of which the n-th call breaks."""

    def __init__(self, statement, at):
        self.statement, self.at = statement, at

    def _step(self):
        self.at -= 1
        if self.at == 0:
            raise RuntimeError("lost")

    def executeQuery(self, sql):  # noqa: N802
        self._step()
        return self.statement.executeQuery(sql)

    def executeUpdate(self, sql):  # noqa: N802
        self._step()
        return self.statement.executeUpdate(sql)


class BreakingConnection:
    def __init__(self, connection, at):
        self.connection, self.at = connection, at

    def createStatement(self):  # noqa: N802
        return Breaking(self.connection.createStatement(), self.at)

    def __getattr__(self, name):
        return getattr(self.connection, name)


@pytest.mark.parametrize("at", range(1, 7))
def test_a_merge_that_breaks_at_any_step_loses_nothing(spark, contract, database, monkeypatch, at):
    url, options = database
    stage, final = name_of("stage"), name_of("final")

    def send():
        return publish(
            spark, contract.table, url, stage, final, ["symbol", "date"], options,
            column_types="symbol VARCHAR(16)", num_partitions=1,
        )

    def finals():
        read = jdbc_source.jdbc_table(spark, url, final, options).collect()
        return sorted((r.symbol, r.date, r.close) for r in read)

    load(spark, contract, make_provider())
    send()
    before = finals()
    load(spark, contract, make_provider(shift=0.5), start=D(2024, 1, 3), end=D(2024, 1, 5))
    connect = jdbc_sink._connect
    with monkeypatch.context() as patch:
        patch.setattr(jdbc_sink, "_connect", lambda *a: BreakingConnection(connect(*a), at))
        with pytest.raises(RuntimeError, match="lost"):
            send()
    assert finals() == before
    assert send() == 4
    assert finals() == days("A", 1, 2) + days("A", 3, 2, 0.5) + days("B", 1, 2) + days("B", 3, 2, 0.5)


def test_merge_refuses_stages_it_cannot_repeat(spark, database):
    url, options = database
    types = {"column_types": "p VARCHAR(8)"}
    for rows, match in (([(1, 1, "x"), (1, 2, "x")], "different rows"), ([(None, 1, "x")], "without a key")):
        stage, final = name_of("stage"), name_of("final")
        jdbc_sink.jdbc_append(frame(spark, rows), url, stage, options, **types)
        with pytest.raises(LoadError, match=match):
            jdbc_sink.jdbc_merge(spark, url, stage, final, ["k"], options, **types)
        assert jdbc_source.jdbc_count(spark, url, final, options) == 0


def test_publish_ignores_rows_a_retry_repeated_in_the_stage(spark, database):
    url, options = database
    stage, final = name_of("stage"), name_of("final")
    rows = frame(spark, [(1, 1, "x"), (2, 2, "y")])
    types = {"column_types": "p VARCHAR(8)"}
    jdbc_sink.jdbc_append(rows, url, stage, options, **types)
    jdbc_sink.jdbc_append(rows.where("k = 2"), url, stage, options)
    assert jdbc_sink.jdbc_merge(spark, url, stage, final, ["k"], options, **types) == 2


def test_a_final_table_with_rows_needs_its_key(spark, database):
    url, options = database
    stage, final = name_of("stage"), name_of("final")
    rows, types = frame(spark, [(1, 1, "x")]), {"column_types": "p VARCHAR(8)"}
    jdbc_sink.jdbc_append(rows, url, stage, options, **types)
    jdbc_sink.jdbc_append(rows, url, final, options, **types)
    with pytest.raises(LoadError, match="no unique key"):
        jdbc_sink.jdbc_merge(spark, url, stage, final, ["k"], options, **types)
    other = name_of("final")
    jdbc_sink.create_keyed(spark, url, other, rows.schema, ["k"], options, **types)
    assert {"k"} in jdbc_sink.unique_keys(spark, url, other, options)
    assert jdbc_sink.unique_keys(spark, url, final, options) == []


def rows_visited(spark, database, sql):
    """How many rows the database reads for one statement, as its own plan says."""
    connection = jdbc_sink._connect(spark, *database)
    try:
        statement = connection.createStatement()
        statement.execute("CALL SYSCS_UTIL.SYSCS_SET_RUNTIMESTATISTICS(1)")
        statement.executeUpdate(sql)
        rows = statement.executeQuery("VALUES SYSCS_UTIL.SYSCS_GET_RUNTIMESTATISTICS()")
        rows.next()
        plan = rows.getString(1)
    finally:
        connection.close()
    return sum(int(n) for n in re.findall(r"Number of rows visited=(\d+)", plan))


def test_the_cost_of_a_merge_follows_the_batch_and_not_the_history(spark, database):
    url, options = database
    visited = []
    for history in (500, 5000):
        stage, final = name_of("stage"), name_of("final")
        old = spark.range(history).selectExpr("CAST(id AS INT) AS k", "0 AS v", "'x' AS p")
        jdbc_sink.create_keyed(spark, url, final, old.schema, ["k", "p"], options, column_types="p VARCHAR(8)")
        jdbc_sink.jdbc_append(old, url, final, options, num_partitions=1)
        batch = spark.range(history - 20, history + 20).selectExpr("CAST(id AS INT) AS k", "1 AS v", "'x' AS p")
        jdbc_sink.jdbc_replace(batch, url, stage, options, column_types="p VARCHAR(8)", num_partitions=1)
        assert jdbc_sink.jdbc_merge(spark, url, stage, final, ["k", "p"], options, column_types="p VARCHAR(8)") == 40
        read = jdbc_source.jdbc_table(spark, url, final, options)
        assert (read.count(), read.where("v = 1").count()) == (history + 20, 40)
        names = [f'"{c}"' for c in "kvp"]
        sql = jdbc_sink.merge_statement(url, f"{stage}_keyed", final, names, names[::2])
        visited.append(rows_visited(spark, database, sql))
    assert visited[1] <= visited[0] + 10 and visited[0] < 400


@pytest.mark.parametrize("kind", ["sqlite", "postgresql", "derby"])
def test_merge_statements_of_other_databases(kind):
    import sqlite3

    import duckdb

    con = sqlite3.connect(":memory:") if kind == "sqlite" else duckdb.connect()
    for t in ("s", "f", "s1", "f1"):
        con.execute(f"CREATE TABLE {t} (k INT, p VARCHAR(8), v INT, PRIMARY KEY (k, p))")
    con.execute("INSERT INTO f VALUES (1, 'x', 0), (2, 'x', 0)")
    con.execute("INSERT INTO s VALUES (2, 'x', 5), (2, 'y', 6)")
    for _ in range(2):
        con.execute(jdbc_sink.merge_statement(f"jdbc:{kind}:db", "s", "f", ["k", "p", "v"], ["k", "p"]))
    assert sorted(con.execute("SELECT * FROM f").fetchall()) == [(1, "x", 0), (2, "x", 5), (2, "y", 6)]
    con.execute(jdbc_sink.merge_statement(f"jdbc:{kind}:db", "s", "f", ["k", "p"], ["k", "p"]))
    assert len(con.execute("SELECT * FROM f").fetchall()) == 3
    mysql = jdbc_sink.merge_statement("jdbc:mysql:db", "s", "f", ["k", "v"], ["k"])
    assert mysql == "INSERT INTO f (k, v) SELECT k, v FROM s ON DUPLICATE KEY UPDATE v = VALUES(v)"
    assert jdbc_sink.merge_statement("jdbc:sqlserver:db", "s", "f", ["k"], ["k"]).endswith("VALUES (s.k);")


def test_publish_refuses_a_batch_with_repeated_keys(spark, namespace, database):
    url, options = database
    sink.write_overwrite(frame(spark, [(1, 1, "x"), (1, 2, "x")]), f"{namespace}.t")
    with pytest.raises(LoadError, match="more than once"):
        publish(spark, f"{namespace}.t", url, name_of("s"), name_of("f"), ["k"], options)
    final = name_of("f")
    assert 1 == publish(
        spark, f"{namespace}.t", url, name_of("s"), final, ["k"], options,
        column_types="p VARCHAR(8)", keep_first_by=[F.desc("v")],
    )
    assert jdbc_source.jdbc_table(spark, url, final, options).first().v == 2
