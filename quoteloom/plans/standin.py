"""Inputs of the acceptance queries, derived from the driver's tables.

There is no quote service here, so daily bars are made from ``events``: one
series per user.  This is test data, not a feature of the library.  A user never
has two events at the same instant, which makes first and last value definite.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quoteloom.contract import Contract
from quoteloom.errors import LoadError
from quoteloom.operators.incremental import build_worklist, high_water_mark
from quoteloom.operators.fetch import Provider
from quoteloom.operators.projection import rename
from quoteloom.shared import fresh_path, is_local
from quoteloom.sinks.tables import create_namespace

# Fixed values of the acceptance queries; the SQL they are compared with uses the same.
FIRST_DAY = "2024-01-01"
OVERLAP_DAY = "2024-01-13"
LOADED_BEFORE = "2024-01-15"
RUN_DATE = "2024-01-25"
PERIOD_END = "2024-02-15"
STAMP = "2024-01-25T06:00:00"
EARLIER_STAMP = "2024-01-15T06:00:00"
PRICE_FLOOR = 0.25
PIECE_DAYS = 8

# The columns a quote service delivers, their names in tables, and the contract.
SOURCE_TO_TABLE = {
    "Date": "date",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Volume": "volume",
    "Dividends": "dividends",
    "Stock Splits": "stock_splits",
}
SOURCE_COLUMNS = list(SOURCE_TO_TABLE)
SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
        T.StructField("Dividends", T.DoubleType()),
        T.StructField("Stock Splits", T.DoubleType()),
    ]
)

QUOTES = Contract.from_spec(
    "quotes",
    {
        "schema": [
            {"name": "date", "type": "DateType", "nullable": False, "source": "Date"},
            {"name": "open", "type": "DoubleType", "source": "Open"},
            {"name": "high", "type": "DoubleType", "source": "High"},
            {"name": "low", "type": "DoubleType", "source": "Low"},
            {"name": "close", "type": "DoubleType", "source": "Close"},
            {"name": "volume", "type": "LongType", "source": "Volume"},
            {"name": "dividends", "type": "DoubleType", "source": "Dividends"},
            {"name": "stock_splits", "type": "DoubleType", "source": "Stock Splits"},
            {"name": "symbol", "type": "StringType", "nullable": False},
            {"name": "import_time", "type": "TimestampType", "nullable": False},
        ],
        "keys": ["symbol", "date"],
    },
)

# ---- the stand-in for a quote service: ranged calls on a bucketed copy of the bars ----------

KEYS_PER_BUCKET = 64
# Small row groups: a call reads the one or two that hold its key, not the bucket.
ROW_GROUP_BYTES = 1 << 20


def land_standin_feed(
    rows: DataFrame, n_keys: int, key: str = "symbol", date: str = "date"
) -> tuple[str, int]:
    """Write ``rows`` as a feed in the shared folder; returns its path and bucket count.

    The bucket count follows the number of keys, which may be an estimate.  A bucket
    that a hot key makes too large is written by several tasks as several files.
    """
    buckets = max(1, math.ceil(n_keys / KEYS_PER_BUCKET))
    path = fresh_path(rows.sparkSession, "feed")
    (
        rows.withColumn("bucket", F.pmod(F.crc32(F.col(key).cast("string")), F.lit(buckets)))
        .hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", key, date)
        .write.option("parquet.block.size", ROW_GROUP_BYTES)
        .partitionBy("bucket")
        .parquet(path)
    )
    return path, buckets


def standin_provider(
    path: str,
    buckets: int,
    columns: list[str],
    *,
    key: str = "symbol",
    date: str = "date",
    floor: tuple[str, float] | None = None,
) -> Provider:
    """Provider over a landed feed.

    With ``floor=(column, value)`` a call raises when any row in its range is below
    that value, as a strict service would refuse a bad series.
    """
    opened: dict = {}

    def provider(item, start, end):
        import zlib

        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        from pyarrow import fs

        bucket = zlib.crc32(str(item).encode()) % buckets
        if bucket not in opened:
            filesystem, root = fs.FileSystem.from_uri(path)
            folder = f"{root}/bucket={bucket}"
            found = filesystem.get_file_info(folder).type == fs.FileType.Directory
            opened[bucket] = ds.dataset(folder, filesystem=filesystem) if found else None
        if opened[bucket] is None:
            raise LookupError(f"unknown key {item}")
        wanted = (ds.field(key) == item) & (ds.field(date) >= start)
        if end is not None:
            wanted = wanted & (ds.field(date) < end)
        # the task is the unit of parallelism; reader threads would only compete with it
        rows = opened[bucket].to_table(columns=columns, filter=wanted, use_threads=False)
        if floor is not None and pc.any(pc.less(rows[floor[0]], floor[1])).as_py():
            raise ValueError(f"{item}: {floor[0]} below {floor[1]}")
        return rows

    return provider


_feeds: dict[tuple[str, str], tuple[str, int]] = {}
_databases: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select(_symbol())


def _symbol():
    return F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: symbol, date, open, high, low, close, volume."""
    daily = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.to_date("ts").alias("date"))
        .agg(
            F.min_by("value", "ts").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "ts").alias("close"),
            F.count("*").alias("volume"),
        )
    )
    return daily.select(_symbol(), "date", "open", "high", "low", "close", "volume")


def source_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars in the shape a quote service delivers them."""
    full = bars(spark, sf_dir).withColumns(
        {"dividends": F.lit(0.0), "stock_splits": F.lit(0.0)}
    )
    return rename(full, {t: s for s, t in SOURCE_TO_TABLE.items()})


def before(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col("date") < F.lit(day).cast("date"))


def since(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col("date") >= F.lit(day).cast("date"))


def marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_water_mark(before(bars(spark, sf_dir), LOADED_BEFORE))


def worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_worklist(symbols(spark, sf_dir), marks(spark, sf_dir), FIRST_DAY)


def provider(spark: SparkSession, sf_dir: str, floor: float | None = None):
    """A provider over all bars, landed once for each application and input folder."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _feeds:
        users = table(spark, sf_dir, "events").agg(F.approx_count_distinct("user_id"))
        _feeds[at] = land_standin_feed(source_bars(spark, sf_dir), users.first()[0], date="Date")
    path, buckets = _feeds[at]
    return standin_provider(
        path,
        buckets,
        SOURCE_COLUMNS,
        date="Date",
        floor=None if floor is None else ("Low", floor),
    )


def new_namespace(spark: SparkSession) -> str:
    """A fresh namespace whose tables live in the shared folder."""
    name = f"quoteloom_{uuid.uuid4().hex}"
    create_namespace(spark, name, fresh_path(spark, "namespace"))
    return name


def database(spark: SparkSession) -> tuple[str, dict[str, str]]:
    """JDBC address and options for the relational queries.

    ``spark.quoteloom.jdbc.url`` (and ``.driver``) name the database.  A plain local
    session without it uses the embedded database that ships with Spark, which only
    its own process can see.
    """
    url = spark.conf.get("spark.quoteloom.jdbc.url", None)
    if url:
        driver = spark.conf.get("spark.quoteloom.jdbc.driver", None)
        return url, {"driver": driver} if driver else {}
    if not is_local(spark):
        raise LoadError("set spark.quoteloom.jdbc.url to a database every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _databases:
        folder = fresh_path(spark, "database").removeprefix("file://").removeprefix("file:")
        _databases[app] = f"jdbc:derby:{folder};create=true"
    return _databases[app], {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def new_table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"
