"""Bronze, silver and gold folders: writers, readers, idempotent loads, retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.config import SIGNAL_PREFIX
from tradeloom.functions.columns import iso_to_ts, ms_to_ts
from tradeloom.operators.detectors import explode_snapshots
from tradeloom.schemas import FEATURES, GOLD_TABLES, SIGNAL_TABLE, TRADE, column_names
from tradeloom.sources.ingest import parse_trades, typed_signals, validate_signals

HOURLY = ("year", "month", "day", "hour")

# ---- bronze ----------------------------------------------------------------------------------------


def hourly_parts(at: Column) -> dict[str, Column]:
    return {
        "year": F.date_format(at, "yyyy"),
        "month": F.date_format(at, "MM"),
        "day": F.date_format(at, "dd"),
        "hour": F.date_format(at, "HH"),
    }


def with_number(line: Column, seq: Column) -> Column:
    """A line of JSON with the record's arrival number as its last field; all else stays as it came."""
    return F.regexp_replace(line, F.lit(r"\}\s*$"), F.concat(F.lit(',"seq":'), seq.cast("bigint").cast("string"), F.lit("}")))


def write_bronze(lines: DataFrame, at: Column, path: str, mode: str = "append", spread: int = 4) -> None:
    """Gzip ``value`` lines under hourly folders; an hour is written by up to ``spread`` tasks."""
    parted = lines.select("value", *[c.alias(n) for n, c in hourly_parts(at).items()])
    salt = F.pmod(F.xxhash64("value"), F.lit(spread))
    (
        parted.repartition(*HOURLY, salt)
        .write.mode(mode)
        .partitionBy(*HOURLY)
        .option("compression", "gzip")
        .text(path)
    )


def _hour_folder() -> Column:
    return F.concat_ws("-", *HOURLY)


def read_bronze(
    spark: SparkSession, path: str, since: datetime | None = None, until: datetime | None = None, arrival: bool = False
) -> DataFrame:
    """Trades of the hourly folders from ``since`` on; unreadable lines and files are skipped.

    With ``arrival`` they have the number ``seq`` that they were archived with, null for lines without one.

    With both ends given, only the folders of those hours are looked for, whatever else the archive holds. With one,
    the time filter is turned into a folder filter, so older folders are not opened. A trade of an
    hour may be stored in the next one (it is filed by arrival), never in an earlier one.
    """
    schema = "value string, year string, month string, day string, hour string"
    reader = spark.read.option("ignoreCorruptFiles", "true").option("basePath", path).schema(schema)
    folders = [path]
    if since is not None and until is not None:
        hours = int((until - since.replace(minute=0, second=0, microsecond=0)).total_seconds() // 3600)
        each = [since + timedelta(hours=h) for h in range(hours + 1)]
        folders = present(spark, [f"{path}/{h:year=%Y/month=%m/day=%d/hour=%H}" for h in each])
    lines = reader.text(folders) if folders else spark.createDataFrame([], schema)
    if since is not None:
        lines = lines.filter(_hour_folder() >= since.strftime("%Y-%m-%d-%H"))
    if until is not None:
        lines = lines.filter(_hour_folder() <= until.strftime("%Y-%m-%d-%H"))
    trades = parse_trades(lines, "value", schema=f"{TRADE}, seq bigint" if arrival else TRADE)
    if since is not None:
        trades = trades.filter(F.coalesce("t", F.lit(0)) >= _epoch_ms(since))
    return trades


def recent_bronze(spark: SparkSession, path: str, now: datetime, lookback_ms: int, arrival: bool = False) -> DataFrame:
    """What a restarting detector replays: the last ``lookback_ms``, across midnight too."""
    return read_bronze(spark, path, now - timedelta(milliseconds=lookback_ms), now, arrival)


def lookback_bronze(spark: SparkSession, path: str, now: datetime, days: int = 14, arrival: bool = False) -> DataFrame:
    """What the feature job reads."""
    return read_bronze(spark, path, now - timedelta(days=days), now + timedelta(hours=1), arrival)


def present(spark: SparkSession, folders: Sequence[str]) -> list[str]:
    """Those of the folders that exist, in whatever store they lie."""
    sc = spark.sparkContext
    paths = [(f, sc._jvm.org.apache.hadoop.fs.Path(f)) for f in folders]
    return [f for f, p in paths if p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p)]


def with_arrival(trades: DataFrame) -> DataFrame:
    """Archived trades with an arrival number each: the one that they were archived with.

    Lines of an archive that holds none take numbers by price and volume among the trades of their symbol and time, so a re-read
    gives the same; they come after numbered ones. Equal lines are counted first, so an instant's task holds its distinct prices
    and volumes, not its trades.
    """
    if "seq" not in trades.columns:
        trades = trades.withColumn("seq", F.lit(None).cast("bigint"))
    same_time = Window.partitionBy("s", "t").orderBy("p", "v")
    before = F.coalesce(F.sum("_n").over(same_time.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = trades.filter("seq is not null")
    first = known.groupBy("s", "t").agg((F.max("seq") + 1).alias("_first"))
    bare = trades.filter("seq is null").groupBy("s", "p", "v", "t").agg(F.count(F.lit(1)).alias("_n"))
    bare = bare.withColumn("_from", before).join(first, ["s", "t"], "left")
    start = F.col("_from") + F.coalesce("_first", F.lit(0))
    numbers = F.explode(F.sequence(start, start + F.col("_n") - 1)).alias("seq")
    return known.select("s", "p", "v", "t", "seq").union(bare.select("s", "p", "v", "t", numbers))


def store_trades(trades: DataFrame, path: str, spread: int = 8) -> None:
    """Archived trades as Parquet by day, the form that the batch pipeline reads several times.

    A day is written by up to ``spread`` tasks, and a task writes few days.
    """
    salt = F.pmod(F.xxhash64("s", "t", "seq"), F.lit(spread))
    (
        with_arrival(trades)
        .withColumn("date", F.to_date(ms_to_ts(F.col("t"))))
        .repartition("date", salt)
        .write.mode("overwrite")
        .partitionBy("date")
        .parquet(path)
    )


def _epoch_ms(at: datetime) -> int:
    at = at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at
    return int(at.timestamp() * 1000)


# ---- silver ----------------------------------------------------------------------------------------


def silver_path(kind: Column, symbol: Column, stamp: Column) -> Column:
    """``silver/<prefix>/yyyy/MM/dd/<time>[_<symbol>].json``; snapshots carry no symbol in the name."""
    prefix = F.create_map(*[F.lit(x) for pair in SIGNAL_PREFIX.items() for x in pair])[kind]
    name = F.regexp_replace(stamp, ":", "-")
    day = F.date_format(iso_to_ts(stamp), "yyyy/MM/dd")
    return F.concat(
        F.concat_ws("/", F.lit("silver"), prefix, day, F.when(kind == "sector_snapshot", name).otherwise(F.concat_ws("_", name, symbol))),
        F.lit(".json"),
    )


def route_silver(checked: DataFrame, arrival: str, raw: str = "body") -> DataFrame:
    """The archive content after these validated records: one object per path, the last arrival wins."""
    valid = checked.filter("is_valid")
    stamp = F.coalesce(F.col("values")["detected_at"], F.col("values")["snapshot_ts"])
    return (
        valid.withColumn("stamp", stamp)
        .withColumn("path", silver_path(F.col("signal_type"), F.col("values")["symbol"], F.col("stamp")))
        .groupBy("path")
        .agg(
            F.max_by(F.struct("signal_type", "stamp", raw), arrival).alias("_last"),
            F.max(arrival).alias(arrival),
        )
        .select(
            "path",
            F.col("_last.signal_type").alias("signal_type"),
            F.to_date(iso_to_ts(F.col("_last.stamp"))).alias("date"),
            F.col(f"_last.{raw}").alias(raw),
            arrival,
        )
    )


def write_silver(objects: DataFrame, path: str, mode: str = "append") -> None:
    objects.write.mode(mode).partitionBy("signal_type", "date").parquet(path)


def silver_kind(path: Column) -> Column:
    """The signal type that the second part of an archive path stands for; null for any other path."""
    parts = F.split(path, "/")
    kinds = F.create_map(*[F.lit(x) for kind, prefix in SIGNAL_PREFIX.items() for x in (prefix, kind)])
    return F.when(F.get(parts, F.lit(0)) == "silver", kinds[F.get(parts, F.lit(1))])


def read_silver(objects: DataFrame, path: str = "path", raw: str = "body") -> DataFrame:
    """Validated records of archive objects; foreign paths, bad JSON and records of another kind are dropped."""
    checked = validate_signals(objects.withColumn("_kind", silver_kind(F.col(path))), raw)
    return checked.filter(F.col("is_valid") & (F.col("_kind") == F.col("signal_type"))).drop("_kind")


# ---- gold ------------------------------------------------------------------------------------------


def gold_from_signals(valid: DataFrame, kind: str, processed_at: Column) -> DataFrame:
    """Gold rows of the valid records of one kind; a snapshot record becomes one row per symbol."""
    rows = typed_signals(valid, kind)
    if kind == "sector_snapshot":
        rows = explode_snapshots(rows, "snapshot_ts").withColumn("last_trade_ts", ms_to_ts(F.col("last_trade_ts")))
        rows = rows.withColumn("snapshot_ts", iso_to_ts(F.col("snapshot_ts")))
    else:
        rows = rows.withColumn("detected_at", iso_to_ts(F.col("detected_at")))
        if kind == "momentum_signal":
            rows = rows.withColumn("window_start_ts", ms_to_ts(F.col("window_start_ts")))
            rows = rows.withColumn("window_end_ts", ms_to_ts(F.col("window_end_ts")))
        else:
            rows = rows.withColumn("timestamp", ms_to_ts(F.col("trade_ts")))
    ddl, _, report_time = GOLD_TABLES[SIGNAL_TABLE[kind]]
    return (
        rows.withColumn("processed_at", processed_at)
        .select(*column_names(ddl))
        .withColumn("date", F.to_date(report_time))
    )


def new_rows(existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not there yet; among equal keys the first by ``order`` wins.

    Copies of a key collapse before the shuffle, so a key that fills a batch costs one row per task.
    """
    rest = [c for c in incoming.columns if c not in key]
    first = (
        incoming.groupBy(*key)
        .agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("_first"))
        .select(*key, *[F.col(f"_first.{c}").alias(c) for c in rest])
    )
    return first.join(existing.select(*key), list(key), "left_anti").select(*incoming.columns)


def create_gold(spark: SparkSession, database: str, path: str) -> None:
    """Create the four gold tables where they do not exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, (ddl, _, _) in GOLD_TABLES.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({ddl}, date date) "
            f"USING parquet PARTITIONED BY (date) LOCATION '{path}/{table}'"
        )


class GoldFolder:
    """The four gold tables as Parquet folders partitioned by date."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def __getattr__(self, table: str) -> DataFrame:
        if table not in GOLD_TABLES:
            raise AttributeError(table)
        return self.read(table)

    def read(self, table: str) -> DataFrame:
        ddl = GOLD_TABLES[table][0]
        folder = f"{self.path}/{table}"
        try:
            return self.spark.read.schema(f"{ddl}, date date").parquet(folder)
        except Exception as error:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], f"{ddl}, date date")

    def upsert(self, table: str, incoming: DataFrame) -> None:
        """Append the rows with new keys. Loading the same rows again changes nothing.

        Only partitions that can hold a key of the batch are read: the report day of a row is never before
        the day of its key.
        """
        _, key_time, _ = GOLD_TABLES[table]
        bounds = incoming.agg(F.to_date(F.min(key_time)).alias("first")).first()
        if bounds is None or bounds["first"] is None:
            return
        present = self.read(table).filter(F.col("date") >= F.lit(bounds["first"]))
        fresh = new_rows(present, incoming, (key_time, "symbol"), ("processed_at",))
        order = ("date", "symbol", key_time)
        (
            fresh.repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .write.mode("append")
            .partitionBy("date")
            .parquet(f"{self.path}/{table}")
        )


# ---- features --------------------------------------------------------------------------------------


def write_feature_csv(features: DataFrame, path: str) -> None:
    """``split=train`` and ``split=validation`` folders of CSV with a header."""
    features.write.mode("overwrite").option("header", True).partitionBy("split").csv(path)


def read_feature_csv(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    rows = spark.read.schema(f"{FEATURES}, split string").option("header", True).csv(path)
    return rows if split is None else rows.filter(F.col("split") == split)


# ---- retention -------------------------------------------------------------------------------------

# Days that each layer is kept.
RETENTION_DAYS = {"bronze": 90, "silver": 90, "features": 30}


def expired_partitions(rows: DataFrame, layer: str, as_of: date, day: str = "date") -> DataFrame:
    """Day partitions of a layer that are older than it is kept, with their row counts."""
    cutoff = as_of - timedelta(days=RETENTION_DAYS[layer])
    return (
        rows.filter(F.col(day) < F.lit(cutoff))
        .groupBy(F.col(day).alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(layer).alias("layer"), "date", "n")
    )


#: Folder names that tell a layer's days.
DAY_FOLDERS = {"bronze": "year=*/month=*/day=*", "silver": "signal_type=*/date=*", "features": "date=*"}


def drop_expired(spark: SparkSession, path: str, layer: str, as_of: date, dry_run: bool = True) -> list[str]:
    """Day folders of a layer that are older than it is kept, by their names alone; deleted unless it is a dry run."""
    cutoff = as_of - timedelta(days=RETENTION_DAYS[layer])
    sc = spark.sparkContext
    pattern = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/{DAY_FOLDERS[layer]}")
    fs = pattern.getFileSystem(sc._jsc.hadoopConfiguration())
    old = []
    for status in fs.globStatus(pattern) or []:
        parts = dict(p.split("=", 1) for p in status.getPath().toString().split("/") if "=" in p)
        day = parts.get("date") or "-".join(parts[k] for k in HOURLY[:3])
        if date.fromisoformat(day) < cutoff:
            old.append(status.getPath())
    if not dry_run:
        for folder in old:
            fs.delete(folder, True)
    return sorted(p.toString() for p in old)
