"""The acceptance queries: each runs one capability over the driver's whole tables.

Queries of sinks write to a fresh place in the shared folder and return what is
read back from there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quoteloom.contract import Contract
from quoteloom.functions import date_text, local_date, parse_date, stamp_ms_text, stamp_text
from quoteloom.operators import checks, fetch, incremental, intervals, projection, quality, ranges
from quoteloom.plans import standin as s
from quoteloom.plans.loading import load_raw, publish, publish_marks
from quoteloom.shared import fresh_path, land
from quoteloom.sinks import jdbc as jdbc_sink
from quoteloom.sinks import tables as sink
from quoteloom.sources import files, function, rows
from quoteloom.sources import jdbc as jdbc_source
from quoteloom.sources import tables as source

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

LINE_KEY = ["l_orderkey", "l_linenumber"]
BAR_KEY = ["symbol", "date"]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def to_table_names(df: DataFrame) -> DataFrame:
    return projection.rename(df, s.SOURCE_TO_TABLE)


# ---- fetch ---------------------------------------------------------------------


@query
def q_fetch_ranged(spark, sf_dir):
    got = fetch.fetch(
        s.worklist(spark, sf_dir),
        s.provider(spark, sf_dir),
        s.SOURCE_SCHEMA,
        run_date=s.RUN_DATE,
    )
    return to_table_names(land(got, "fetch"))


@query
def q_fetch_split(spark, sf_dir):
    pieces = fetch.split_ranges(s.worklist(spark, sf_dir), 4, s.RUN_DATE)
    got = fetch.fetch(
        pieces, s.provider(spark, sf_dir), s.SOURCE_SCHEMA, on_error="route"
    )
    return to_table_names(fetch.whole_keys_only(land(got, "fetch")))


@query
def q_fetch_open_ended(spark, sf_dir):
    got = fetch.fetch(
        s.worklist(spark, sf_dir), s.provider(spark, sf_dir), s.SOURCE_SCHEMA, open_ended=True
    )
    return to_table_names(land(got, "fetch"))


@query
def q_fetch_period(spark, sf_dir):
    wanted = fetch.period_worklist(s.symbols(spark, sf_dir), 1, s.PERIOD_END)
    got = fetch.fetch(wanted, s.provider(spark, sf_dir), s.SOURCE_SCHEMA)
    return to_table_names(land(got, "fetch"))


@query
def q_fetch_isolate(spark, sf_dir):
    got = fetch.fetch(
        s.worklist(spark, sf_dir),
        s.provider(spark, sf_dir, s.PRICE_FLOOR),
        s.SOURCE_SCHEMA,
        run_date=s.RUN_DATE,
        on_error="drop",
    )
    return to_table_names(land(got, "fetch"))


@query
def q_fetch_errors(spark, sf_dir):
    got = fetch.fetch(
        s.worklist(spark, sf_dir),
        s.provider(spark, sf_dir, s.PRICE_FLOOR),
        s.SOURCE_SCHEMA,
        run_date=s.RUN_DATE,
        on_error="route",
    )
    return fetch.fetch_errors(land(got, "fetch"))


@query
def q_fetch_routed(spark, sf_dir):
    """Good rows and error rows in one frame, as a routed fetch lands them."""
    got = fetch.fetch(
        s.worklist(spark, sf_dir),
        s.provider(spark, sf_dir, s.PRICE_FLOOR),
        s.SOURCE_SCHEMA,
        run_date=s.RUN_DATE,
        on_error="route",
    )
    return to_table_names(land(got, "fetch"))


@query
def q_datasource(spark, sf_dir):
    """The fetch of a split work list as a table function in SQL."""
    function.register_fetch_function(
        spark, "quoteloom_feed", s.provider(spark, sf_dir), s.SOURCE_SCHEMA
    )
    pieces = fetch.split_ranges(s.worklist(spark, sf_dir), 4, s.RUN_DATE)
    items = fetch.distribute(fetch.due_items(pieces))
    got = spark.sql("SELECT * FROM quoteloom_feed(TABLE({items}))", items=items)
    return to_table_names(land(got, "fetch"))


@query
def q_worklist_distribute(spark, sf_dir):
    return fetch.distribute(s.worklist(spark, sf_dir))


# ---- incremental logic ------------------------------------------------------------


@query
def q_high_water_mark(spark, sf_dir):
    return s.marks(spark, sf_dir)


@query
def q_advance_marks(spark, sf_dir):
    later = s.before(s.since(s.bars(spark, sf_dir), s.LOADED_BEFORE), s.RUN_DATE)
    return incremental.advance_marks(s.marks(spark, sf_dir), later)


@query
def q_worklist(spark, sf_dir):
    return s.worklist(spark, sf_dir)


@query
def q_range_predicate(spark, sf_dir):
    wanted = land(s.worklist(spark, sf_dir), "worklist")
    return fetch.due_rows(s.bars(spark, sf_dir), wanted, s.FIRST_DAY, s.RUN_DATE)


@query
def q_interval_worklist(spark, sf_dir):
    """Ranges still to load where every third day and every day with one event only is missing."""
    days = s.bars(spark, sf_dir).where("volume > 1 AND day(date) % 3 <> 0")
    loaded = days.select("symbol", F.col("date").alias("start_date"), F.date_add("date", 1).alias("end_date"))
    return intervals.gap_worklist(s.symbols(spark, sf_dir), loaded, s.FIRST_DAY, s.RUN_DATE)


def _overlapping_ranges(spark, sf_dir):
    """Three ranges for each symbol, of its own and overlapping; the last one has no end."""
    n = F.substring("symbol", 2, 20).cast("int")
    first = F.lit(s.FIRST_DAY).cast("date")
    one = F.struct((n % 5).alias("lo"), (n % 5 + 6).alias("hi"))
    two = F.struct(F.lit(3).alias("lo"), F.lit(8).alias("hi"))
    three = F.struct((20 - n % 3).alias("lo"), F.lit(None).cast("int").alias("hi"))
    ranges = s.symbols(spark, sf_dir).select("symbol", F.explode(F.array(one, two, three)).alias("r"))
    return ranges.select(
        "symbol", F.date_add(first, F.col("r.lo")).alias("start_date"), F.date_add(first, F.col("r.hi")).alias("end_date")
    )


@query
def q_range_join(spark, sf_dir):
    return ranges.join_ranges(s.bars(spark, sf_dir), _overlapping_ranges(spark, sf_dir), bin_days=8)


@query
def q_range_ends(spark, sf_dir):
    """A work list with ends of its own, in the set form."""
    wanted = land(_overlapping_ranges(spark, sf_dir), "worklist")
    return fetch.due_rows(s.bars(spark, sf_dir), wanted, s.FIRST_DAY)


@query
def q_merge_upsert(spark, sf_dir):
    all_bars = s.bars(spark, sf_dir)
    revised = s.since(all_bars, s.OVERLAP_DAY).withColumn("close", F.col("close") + 1)
    return incremental.upsert(s.before(all_bars, s.LOADED_BEFORE), revised, BAR_KEY)


@query
def q_dedup_key(spark, sf_dir):
    return incremental.dedup_by_key(s.table(spark, sf_dir, "lineitem"), LINE_KEY)


# ---- projection and contract ---------------------------------------------------------


@query
def q_project_fixed(spark, sf_dir):
    return projection.project(s.source_bars(spark, sf_dir), ["symbol", *s.SOURCE_COLUMNS])


@query
def q_project_narrow(spark, sf_dir):
    return projection.project(s.bars(spark, sf_dir), ["symbol", "date", "open", "close"])


@query
def q_rename(spark, sf_dir):
    return to_table_names(s.source_bars(spark, sf_dir))


@query
def q_lineage(spark, sf_dir):
    return projection.add_lineage(s.bars(spark, sf_dir), s.STAMP, feed="events")


NARROW_QUOTES = Contract.from_spec(
    "narrow_quotes",
    {
        "schema": [
            {"name": "date", "type": "DateType", "nullable": False},
            {"name": "open", "type": "FloatType"},
            {"name": "high", "type": "FloatType"},
            {"name": "low", "type": "FloatType"},
            {"name": "close", "type": "FloatType"},
            {"name": "volume", "type": "IntegerType"},
            {"name": "symbol", "type": "StringType", "nullable": False},
        ]
    },
)


def _large_volume_bars(spark, sf_dir):
    # from four events a day on the volume no longer fits the narrow contract
    return s.bars(spark, sf_dir).withColumn("volume", F.col("volume") * 600_000_000)


@query
def q_contract_cast(spark, sf_dir):
    return checks.check(_large_volume_bars(spark, sf_dir), NARROW_QUOTES).kept


@query
def q_contract_rejects(spark, sf_dir):
    rejects = checks.check(_large_volume_bars(spark, sf_dir), NARROW_QUOTES).rejects
    return rejects.select(
        "symbol", "date", "volume", F.array_join(checks.VIOLATIONS, "; ").alias("violation")
    )


LINES = Contract.from_spec(
    "lines",
    {
        "schema": [
            {"name": "l_orderkey", "type": "LongType", "nullable": False},
            {"name": "l_linenumber", "type": "IntegerType", "nullable": False},
            {"name": "l_partkey", "type": "LongType"},
            {"name": "l_quantity", "type": "DoubleType", "nullable": False},
            {"name": "l_discount", "type": "DoubleType", "nullable": False},
        ]
    },
)


def _gappy_lines(spark, sf_dir):
    """lineitem with quantities of 50 and discounts of 0 missing."""
    return s.table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        "l_partkey",
        F.nullif("l_quantity", F.lit(50.0)).alias("l_quantity"),
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
    )


@query
def q_contract_nulls(spark, sf_dir):
    rejects = checks.check(_gappy_lines(spark, sf_dir), LINES).rejects
    return rejects.withColumn(checks.VIOLATIONS, F.array_join(checks.VIOLATIONS, "; "))


@query
def q_null_audit(spark, sf_dir):
    return quality.null_audit(_gappy_lines(spark, sf_dir))


@query
def q_incomplete_rows(spark, sf_dir):
    return quality.incomplete_rows(_gappy_lines(spark, sf_dir), LINES.required)


@query
def q_cast_string(spark, sf_dir):
    events = s.table(spark, sf_dir, "events").select("event_id", "value")
    return projection.cast_to_string(events, ["value"])


@query
def q_limit(spark, sf_dir):
    return projection.limit_ordered(s.bars(spark, sf_dir), 550, ["date", "symbol"])


# ---- scalar functions ------------------------------------------------------------------


def _events_with(spark, sf_dir, column):
    return s.table(spark, sf_dir, "events").select("event_id", column)


@query
def q_tz_date(spark, sf_dir):
    return _events_with(
        spark, sf_dir, local_date("ts", "America/New_York", "UTC").alias("local_date")
    )


@query
def q_format_ts(spark, sf_dir):
    return _events_with(spark, sf_dir, stamp_text("ts").alias("ts_text"))


@query
def q_format_date(spark, sf_dir):
    return _events_with(spark, sf_dir, date_text("ts").alias("date_text"))


@query
def q_stamp_ms(spark, sf_dir):
    return _events_with(spark, sf_dir, stamp_ms_text("ts").alias("ts_text"))


@query
def q_parse_date(spark, sf_dir):
    text = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("about "), date_text("o_orderdate")))
    orders = s.table(spark, sf_dir, "orders").select(
        "o_orderkey", text.otherwise(date_text("o_orderdate")).alias("text")
    )
    return orders.withColumn("order_date", parse_date("text"))


# ---- audits and nested records ---------------------------------------------------------


@query
def q_count(spark, sf_dir):
    return quality.count_rows(s.table(spark, sf_dir, "lineitem"))


@query
def q_dedup_exact(spark, sf_dir):
    return quality.drop_exact_duplicates(s.table(spark, sf_dir, "lineitem").select(*LINE_KEY))


@query
def q_duplicate_report(spark, sf_dir):
    return quality.duplicate_report(s.table(spark, sf_dir, "lineitem"), LINE_KEY)


@query
def q_flatten(spark, sf_dir):
    def entry(name):
        return F.struct(
            F.lit(name).alias("measure"), F.col(name).cast("double").alias("value")
        )

    nested = s.bars(spark, sf_dir).withColumn(
        "groups",
        F.array(
            F.array(*[entry(c) for c in ("open", "high", "low", "close")]),
            F.array(entry("volume")),
        ),
    )
    return quality.flatten_records(nested, "groups", BAR_KEY)


@query
def q_empty_typed(spark, sf_dir):
    """A batch in which every symbol is up to date: no rows, but the contract's columns."""
    loaded = s.bars(spark, sf_dir)
    up_to_date = incremental.build_worklist(
        s.symbols(spark, sf_dir), incremental.high_water_mark(loaded), s.FIRST_DAY
    )
    due = fetch.due_rows(loaded, land(up_to_date, "worklist"), s.FIRST_DAY, s.PERIOD_END)
    batch = quality.typed_empty(spark, s.QUOTES).unionByName(due, allowMissingColumns=True)
    return batch.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(len(batch.columns)).alias("n_columns"),
    )


@query
def q_reconcile(spark, sf_dir):
    lines = _gappy_lines(spark, sf_dir)
    checked = checks.check(lines, LINES)
    name = f"{s.new_namespace(spark)}.lines"
    sink.write_overwrite(checked.kept, name)
    return quality.reconcile(lines, source.scan(spark, name), checked.rejects)


# ---- remaining sources ------------------------------------------------------------------


@query
def q_inline_rows(spark, sf_dir):
    """An inline lookup with a declared schema, joined to every order."""
    ranks = rows.inline_rows(
        spark,
        [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)],
        T.StructType(
            [
                T.StructField("o_orderpriority", T.StringType(), False),
                T.StructField("priority_rank", T.IntegerType(), False),
            ]
        ),
    )
    orders = s.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return orders.join(F.broadcast(ranks), "o_orderpriority", "left")


@query
def q_dict_records(spark, sf_dir):
    schema = T.StructType(
        [T.StructField("k", T.LongType()), T.StructField("note", T.StringType())]
    )
    return files.json_records(s.table(spark, sf_dir, "events"), "props", schema, ["event_id"])


@query
def q_csv_seed(spark, sf_dir):
    customers = s.table(spark, sf_dir, "customer")
    path = fresh_path(spark, "csv")
    customers.write.csv(path, header=True)
    return files.csv_with_header(spark, path, customers.schema)


@query
def q_infer_names(spark, sf_dir):
    customers = s.table(spark, sf_dir, "customer")
    path = fresh_path(spark, "csv")
    customers.write.csv(path, header=False)
    inferred = files.csv_with_names(spark, path, customers.columns)
    # whole numbers are inferred as int or bigint, by their size: both are shown as text
    return inferred.withColumns(
        {
            "c_custkey": F.col("c_custkey").cast("string"),
            "custkey_type": F.lit(inferred.schema["c_custkey"].dataType.simpleString()),
        }
    )


# ---- tables ----------------------------------------------------------------------------


@query
def q_table_scan(spark, sf_dir):
    name = f"{s.new_namespace(spark)}.orders"
    sink.write_overwrite(s.table(spark, sf_dir, "orders"), name)
    return source.scan(spark, name)


@query
def q_sql_scan(spark, sf_dir):
    name = f"{s.new_namespace(spark)}.customer"
    sink.write_overwrite(s.table(spark, sf_dir, "customer"), name)
    return source.sql_scan(spark, name)


@query
def q_table_count(spark, sf_dir):
    name = f"{s.new_namespace(spark)}.lineitem"
    sink.write_overwrite(s.table(spark, sf_dir, "lineitem"), name)
    return source.sql_count(spark, name)


BARS = Contract.from_spec(
    "bars",
    {
        "schema": [
            {"name": "symbol", "type": "StringType", "nullable": False},
            {"name": "date", "type": "DateType", "nullable": False},
            {"name": "open", "type": "DoubleType"},
            {"name": "high", "type": "DoubleType"},
            {"name": "low", "type": "DoubleType"},
            {"name": "close", "type": "DoubleType"},
            {"name": "volume", "type": "LongType"},
        ],
        "keys": BAR_KEY,
    },
)


def _new_bars_table(spark, *partition_by) -> str:
    contract = BARS.at(f"{s.new_namespace(spark)}.bars").partitioned_by(*partition_by)
    sink.create_table(spark, contract)
    return contract.table


@query
def q_table_create(spark, sf_dir):
    """The created table's columns and types, with their counts after one append."""
    name = _new_bars_table(spark)
    sink.write_append(s.bars(spark, sf_dir), name)
    created = source.scan(spark, name)
    types = F.create_map(
        *[F.lit(x) for f in created.schema for x in (f.name, f.dataType.simpleString())]
    )
    return quality.null_audit(created).withColumn("column_type", types[F.col("column_name")])


@query
def q_table_partitioned(spark, sf_dir):
    name = _new_bars_table(spark, "date")
    sink.write_append(s.bars(spark, sf_dir), name)
    listed = spark.sql(f"SHOW PARTITIONS {name}")
    counts = source.scan(spark, name).groupBy("date").agg(F.count("*").alias("n_rows"))
    return listed.join(
        counts.withColumn("partition", F.concat(F.lit("date="), F.col("date").cast("string"))),
        "partition",
        "left",
    ).select("partition", "n_rows")


@query
def q_write_overwrite(spark, sf_dir):
    name = _new_bars_table(spark, "date")
    all_bars = s.bars(spark, sf_dir)
    sink.write_append(s.before(all_bars, s.LOADED_BEFORE), name)
    sink.write_overwrite(s.since(all_bars, s.OVERLAP_DAY), name)
    return source.scan(spark, name)


@query
def q_write_replace(spark, sf_dir):
    """Replace bars by a table of another shape."""
    name = _new_bars_table(spark)
    all_bars = s.bars(spark, sf_dir)
    sink.write_append(s.before(all_bars, s.LOADED_BEFORE), name)
    sink.write_replace(s.since(all_bars, s.OVERLAP_DAY).drop("volume"), name)
    return source.scan(spark, name)


@query
def q_write_append(spark, sf_dir):
    name = _new_bars_table(spark, "date")
    all_bars = s.bars(spark, sf_dir)
    sink.write_append(s.before(all_bars, s.LOADED_BEFORE), name)
    sink.write_append(s.since(all_bars, s.LOADED_BEFORE), name)
    return source.scan(spark, name)


@query
def q_write_partitions(spark, sf_dir):
    name = _new_bars_table(spark, "date")
    all_bars = s.bars(spark, sf_dir)
    sink.write_append(all_bars, name)
    sink.write_partitions(
        s.since(all_bars, s.LOADED_BEFORE).withColumn("close", F.col("close") + 1), name
    )
    return source.scan(spark, name)


def _merge_two_batches(spark, sf_dir, *partition_by):
    name = _new_bars_table(spark, *partition_by)
    all_bars = s.bars(spark, sf_dir)
    sink.write_append(s.before(all_bars, s.LOADED_BEFORE), name)
    revised = s.since(all_bars, s.OVERLAP_DAY).withColumn("close", F.col("close") + 1)
    sink.merge_into(revised, name, BAR_KEY)
    return source.scan(spark, name)


@query
def q_merge_table(spark, sf_dir):
    return _merge_two_batches(spark, sf_dir)


@query
def q_merge_partitions(spark, sf_dir):
    return _merge_two_batches(spark, sf_dir, "date")


@query
def q_merge_bucketed(spark, sf_dir):
    """A merge into a table without a partition column in its key: only touched buckets are rewritten."""
    contract = BARS.at(f"{s.new_namespace(spark)}.bars")
    sink.create_bucketed_table(spark, contract, buckets=16, tasks=2)
    all_bars = s.bars(spark, sf_dir)
    sink.write_append(s.before(all_bars, s.LOADED_BEFORE), contract.table)
    revised = s.since(all_bars, s.OVERLAP_DAY).withColumn("close", F.col("close") + 1)
    sink.merge_into(revised, contract.table, BAR_KEY)
    return source.scan(spark, contract.table).drop(sink.BUCKET)


# ---- relational database ----------------------------------------------------------------


@query
def q_jdbc_query(spark, sf_dir):
    url, options = s.database(spark)
    name = s.new_table_name("worklist")
    jdbc_sink.jdbc_append(
        s.worklist(spark, sf_dir), url, name, options, column_types="symbol VARCHAR(64)"
    )
    return jdbc_source.jdbc_query(
        spark, url, f'SELECT "symbol", "start_date" FROM {name}', options, split_on="start_date"
    )


@query
def q_jdbc_slices(spark, sf_dir):
    """A table with most rows on one date, read in slices of equal size."""
    url, options = s.database(spark)
    name = s.new_table_name("skewed")
    crowded = F.when(F.col("volume") > 1, F.lit(s.OVERLAP_DAY).cast("date")).otherwise(F.col("date"))
    rows = s.bars(spark, sf_dir).select("symbol", crowded.alias("date"), "close", "volume")
    jdbc_sink.jdbc_append(rows, url, name, options, column_types="symbol VARCHAR(64)")
    return jdbc_source.jdbc_table(spark, url, name, options, split_on="date", even=True, then_on="symbol")


@query
def q_jdbc_append(spark, sf_dir):
    url, options = s.database(spark)
    name = s.new_table_name("bars")
    all_bars = s.bars(spark, sf_dir)
    types = "symbol VARCHAR(64)"
    jdbc_sink.jdbc_append(
        s.before(all_bars, s.LOADED_BEFORE), url, name, options, column_types=types
    )
    jdbc_sink.jdbc_append(s.since(all_bars, s.LOADED_BEFORE), url, name, options)
    return jdbc_source.jdbc_table(spark, url, name, options, split_on="date")


@query
def q_jdbc_append_once(spark, sf_dir):
    """Two batches, the second of which is appended again."""
    url, options = s.database(spark)
    name = s.new_table_name("bars")
    all_bars = s.bars(spark, sf_dir)
    types = "symbol VARCHAR(64)"
    for batch, rows in (
        ("early", s.before(all_bars, s.LOADED_BEFORE)),
        ("late", s.since(all_bars, s.LOADED_BEFORE)),
        ("late", s.since(all_bars, s.LOADED_BEFORE)),
    ):
        jdbc_sink.jdbc_append_once(rows, url, name, batch, options, column_types=types)
    return jdbc_source.jdbc_table(spark, url, name, options, split_on="date")


@query
def q_jdbc_stage(spark, sf_dir):
    url, options = s.database(spark)
    name = s.new_table_name("stage")
    all_bars = s.bars(spark, sf_dir)
    types = "symbol VARCHAR(64)"
    jdbc_sink.jdbc_append(
        s.before(all_bars, s.LOADED_BEFORE), url, name, options, column_types=types
    )
    jdbc_sink.jdbc_replace(s.since(all_bars, s.OVERLAP_DAY), url, name, options)
    return jdbc_source.jdbc_table(spark, url, name, options, split_on="date")


# ---- whole loads ------------------------------------------------------------------------


@query
def q_pipeline_raw(spark, sf_dir):
    contract = s.QUOTES.at(f"{s.new_namespace(spark)}.quotes").partitioned_by("date")
    load_raw(
        spark,
        s.worklist(spark, sf_dir),
        s.provider(spark, sf_dir),
        s.SOURCE_SCHEMA,
        contract,
        run_date=s.RUN_DATE,
        stamp=s.STAMP,
    ).clear()
    return source.scan(spark, contract.table)


def _load_two_batches(spark, sf_dir, contract, after_each):
    """Two overlapping batches of all symbols; the second holds some days again."""
    keys = s.symbols(spark, sf_dir)
    for first, end, stamp in (
        (s.FIRST_DAY, s.LOADED_BEFORE, s.EARLIER_STAMP),
        (s.OVERLAP_DAY, s.RUN_DATE, s.STAMP),
    ):
        load_raw(
            spark,
            keys.withColumn("start_date", F.lit(first).cast("date")),
            s.provider(spark, sf_dir),
            s.SOURCE_SCHEMA,
            contract,
            run_date=end,
            stamp=stamp,
            date="Date",
        ).clear()
        after_each()


@query
def q_pipeline_merge(spark, sf_dir):
    """Incremental load within the catalog: raw table, then merge by touched partitions."""
    contract = s.QUOTES.at(f"{s.new_namespace(spark)}.quotes")
    history = contract.at(f"{contract.table}_history").partitioned_by("date")
    sink.create_table(spark, history)
    _load_two_batches(
        spark,
        sf_dir,
        contract,
        lambda: sink.merge_into(
            source.scan(spark, contract.table), history.table, history.keys, landed=True
        ),
    )
    return source.scan(spark, history.table)


@query
def q_pipeline_gaps(spark, sf_dir):
    """A load of which pieces fail, then a load of the holes that it left."""
    contract = s.QUOTES.at(f"{s.new_namespace(spark)}.quotes")
    keys = s.symbols(spark, sf_dir)
    loaded = spark.createDataFrame([], "symbol string, start_date date, end_date date")
    for floor, stamp in ((s.PRICE_FLOOR, s.EARLIER_STAMP), (None, s.STAMP)):
        report = load_raw(
            spark,
            intervals.gap_worklist(keys, loaded, s.FIRST_DAY, s.RUN_DATE),
            s.provider(spark, sf_dir, floor),
            s.SOURCE_SCHEMA,
            contract,
            stamp=stamp,
            date="Date",
            mode="append",
            max_days=s.PIECE_DAYS,
            ledger=fresh_path(spark, "ledger"),
            waves=2,
            retries=0,
            withhold=False,
        )
        loaded = land(intervals.advance_intervals(loaded, report.calls), "loaded")
        report.clear()
    return source.scan(spark, contract.table)


@query
def q_pipeline_publish(spark, sf_dir):
    """Incremental load into a relational database: raw table, stage table, merge."""
    url, options = s.database(spark)
    contract = s.QUOTES.at(f"{s.new_namespace(spark)}.quotes")
    stage, final = s.new_table_name("stage"), s.new_table_name("quotes")
    _load_two_batches(
        spark,
        sf_dir,
        contract,
        lambda: publish(
            spark,
            contract.table,
            url,
            stage,
            final,
            contract.keys,
            options,
            column_types="symbol VARCHAR(64)",
        ),
    )
    return jdbc_source.jdbc_table(spark, url, final, options, split_on="date")


@query
def q_pipeline_incremental(spark, sf_dir):
    """Work list from the database, load, publish, move the marks; then the same again.

    The first round knows all symbols but the last one in order; the second finds that one
    new, and the others where the first round left them.
    """
    url, options = s.database(spark)
    contract = s.QUOTES.at(f"{s.new_namespace(spark)}.quotes")
    known, marks, stage, final = map(s.new_table_name, ("known", "marks", "stage", "quotes"))
    types = "symbol VARCHAR(64)"
    keys = s.symbols(spark, sf_dir)
    newest = keys.agg(F.max("symbol").alias("symbol"))
    none_loaded = spark.createDataFrame([], "symbol string, last_date date")
    jdbc_sink.create_keyed(spark, url, marks, none_loaded.schema, ["symbol"], options, column_types=types)
    rounds = (
        (keys.join(newest, "symbol", "left_anti"), s.LOADED_BEFORE, s.EARLIER_STAMP),
        (newest, s.RUN_DATE, s.STAMP),
    )
    for added, end, stamp in rounds:
        jdbc_sink.jdbc_append(added, url, known, options, column_types=types)
        wanted = incremental.build_worklist(
            jdbc_source.jdbc_table(spark, url, known, options, split_on="symbol", even=True),
            jdbc_source.jdbc_table(spark, url, marks, options, split_on="symbol", even=True),
            s.FIRST_DAY,
        )
        load_raw(
            spark,
            wanted,
            s.provider(spark, sf_dir),
            s.SOURCE_SCHEMA,
            contract,
            run_date=end,
            stamp=stamp,
            date="Date",
        ).clear()
        publish(spark, contract.table, url, stage, final, contract.keys, options, column_types=types)
        publish_marks(spark, contract.table, url, marks, options, column_types=types)
    return jdbc_source.jdbc_table(spark, url, final, options, split_on="date")
