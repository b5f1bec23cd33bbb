"""From wire text to valid trades and valid signals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeloom.schemas import ENVELOPE, FRAME, PAYLOADS, SNAPSHOT_ENTRY, TRADE, UNIFIED_SIGNAL

# ---- frames and trades -----------------------------------------------------------------------------


def frame_kind(raw: str = "value") -> Column:
    """``trade``, ``ping``, ``other``, or ``invalid`` for text that is not a JSON object."""
    kind = F.get_json_object(raw, "$.type")
    is_object = F.json_object_keys(raw).isNotNull()
    return F.when(~is_object, "invalid").when(kind.isin("trade", "ping"), kind).otherwise("other")


def frame_type_counts(frames: DataFrame, raw: str = "value") -> DataFrame:
    return frames.groupBy(frame_kind(raw).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def parse_once(records: DataFrame, raw: str | Column, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """The fields of a JSON column. As a generator, the parse is not repeated by every filter on a field."""
    return records.select(*keep, F.inline(F.array(F.from_json(raw, schema))))


def computed_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that filters and later columns read instead of computing it again."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def parse_frames(frames: DataFrame, raw: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row ``(s, p, v, t)`` per trade of every trade frame; other and unreadable frames vanish.

    ``keep`` names frame columns to carry along, such as the time of receipt.
    """
    frame = parse_once(frames, raw, FRAME, keep)
    exploded = frame.select(*keep, F.explode_outer(F.when(F.col("type") == "trade", F.col("data"))).alias("d"))
    return exploded.filter(F.col("d").isNotNull()).select(*keep, "d.s", "d.p", "d.v", "d.t")


def reject_reason(symbols: Sequence[str], received_ms: Column, staleness_ms: int) -> Column:
    """Why a trade is refused, or null. Trades from the future pass."""
    s, p, v, t = (F.col(c) for c in "spvt")
    return (
        F.when(s.isNull() | ~s.isin(*symbols), "unknown_symbol")
        .when(p.isNull(), "missing_price")
        .when(F.isnan(p) | (p <= 0), "bad_price")
        .when(v.isNull(), "missing_volume")
        .when(v < 0, "bad_volume")
        .when(t.isNull(), "missing_time")
        .when(received_ms - t > staleness_ms, "stale")
    )


def valid_trades(trades: DataFrame, symbols, received_ms: Column, staleness_ms: int) -> DataFrame:
    return trades.filter(reject_reason(symbols, received_ms, staleness_ms).isNull())


def reject_report(trades: DataFrame, symbols, received_ms: Column, staleness_ms: int) -> DataFrame:
    """Refused trades counted per symbol and reason."""
    reason = reject_reason(symbols, received_ms, staleness_ms)
    return (
        trades.select("s", reason.alias("reason"))
        .filter(F.col("reason").isNotNull())
        .groupBy("s", "reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def in_session(t_ms: Column, tz: str = "America/New_York") -> Column:
    """Monday to Friday, 09:30 up to 16:00 exchange time."""
    local = F.from_utc_timestamp(F.timestamp_millis(t_ms), tz)
    minute = F.hour(local) * 60 + F.minute(local)
    return (F.weekday(local) < 5) & (minute >= 570) & (minute < 960)


# ---- stream records --------------------------------------------------------------------------------


def decode_envelopes(records: DataFrame, raw: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Text inside base64 inside a JSON record, as column ``body``; null for records that are not that."""
    envelope = parse_once(records, raw, ENVELOPE, keep)
    return envelope.select(*keep, F.try_to_binary(F.col("kinesis.data"), F.lit("base64")).cast("string").alias("body"))


def parse_trades(records: DataFrame, raw: str = "body", keep: Sequence[str] = (), schema: str = TRADE) -> DataFrame:
    """Trades of JSON records; a record that is null, broken or without a symbol is skipped."""
    return parse_once(records, raw, schema, keep).filter(F.col("s").isNotNull())


def encode_trades(trades: DataFrame) -> DataFrame:
    """Key and JSON value of the raw stream."""
    return trades.select(F.col("s").alias("key"), F.to_json(F.struct("s", "p", "v", "t")).alias("value"))


def encode_signals(signals: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Key and JSON value of the signal stream, each kind with exactly its own fields, nulls kept."""
    missing = [f for f in StructType.fromDDL(UNIFIED_SIGNAL) if f.name not in signals.columns]
    whole = signals.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    value = F.lit(None).cast("string")
    for kind, ddl in PAYLOADS.items():
        body = F.to_json(F.struct(*StructType.fromDDL(ddl).names), {"ignoreNullFields": "false"})
        value = F.when(F.col("signal_type") == kind, body).otherwise(value)
    return whole.select(*keep, F.col("signal_type").alias("key"), value.alias("value"))


# ---- signals ---------------------------------------------------------------------------------------

# Fields of a snapshot entry that must be present but may be null, as `ml_anomaly_score` of a signal may.
_NULLABLE = ("last_price", "open_price", "pct_change", "last_trade_ts")
# The directions of a momentum signal.
_DIRECTIONS = ("UP", "DOWN")


def _fields(ddl: str, nullable: Sequence[str]) -> list[tuple[str, str, bool]]:
    """Name, type and whether null is allowed, of the plain fields of a schema."""
    return [
        (f.name, "direction" if f.name == "direction" else f.dataType.simpleString(), f.name in nullable)
        for f in StructType.fromDDL(ddl)
        if f.name not in ("signal_type", "symbols")
    ]


def _entry_fields() -> list[tuple[str, str, bool]]:
    return _fields(SNAPSHOT_ENTRY, _NULLABLE)


def _signal_fields(kind: str) -> list[tuple[str, str, bool]]:
    return _fields(PAYLOADS[kind], ("ml_anomaly_score",))


def _spec(fields: Sequence[tuple[str, str, bool]]) -> Column:
    return F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(null).alias("nullable")) for n, t, null in fields]
    )


def _typed(text: Column, type_: str) -> Column:
    """Text of a JSON value as a typed value, null when it is not one. Whole floats count as integers."""
    if type_ in ("int", "bigint"):
        number = text.try_cast("double")
        return F.coalesce(text.try_cast(type_), F.when(number == F.floor(number), number).try_cast(type_))
    return text.try_cast("string" if type_ == "direction" else type_)


def _is_bad(values: Column, field: Column) -> Column:
    """A field that is absent, null without leave, or of the wrong type."""
    text, type_ = values[field["name"]], field["type"]
    fits = (
        F.when(type_ == "double", _typed(text, "double").isNotNull())
        .when(type_ == "int", _typed(text, "int").isNotNull())
        .when(type_ == "bigint", _typed(text, "bigint").isNotNull())
        .when(type_ == "boolean", _typed(text, "boolean").isNotNull())
        .when(type_ == "direction", text.isin(*_DIRECTIONS))
        .otherwise(F.lit(True))
    )
    absent = ~F.map_contains_key(values, field["name"])
    return absent | F.when(text.isNull(), ~field["nullable"]).otherwise(~fits)


def _first_bad(values: Column, spec: Column) -> Column:
    return F.get(F.filter(spec, lambda f: _is_bad(values, f)), F.lit(0))["name"]


_ENTRIES = "array<map<string,string>>"


def validate_signals(records: DataFrame, raw: str = "body") -> DataFrame:
    """Add ``signal_type``, ``values`` (the top-level fields as text), ``error`` and ``is_valid``.

    The text is parsed once into a map; a nested list stays text. ``error`` is ``bad_json``,
    ``unknown_type`` or the first field that does not fit.
    """
    parsed = computed_once(records, "values", F.from_json(raw, "map<string,string>")).withColumn(
        "signal_type", F.col("values")["signal_type"]
    )
    values, kind = F.col("values"), F.col("signal_type")
    specs = F.create_map(*[x for k in PAYLOADS for x in (F.lit(k), _spec(_signal_fields(k)))])
    entries = F.from_json(values["symbols"], _ENTRIES)
    entries_fit = F.forall(entries, lambda e: _first_bad(e, _spec(_entry_fields())).isNull())
    bad_symbols = F.when((kind == "sector_snapshot") & ~F.coalesce(entries_fit, F.lit(False)), "symbols")
    known = F.coalesce(kind.isin(*PAYLOADS), F.lit(False))
    error = F.when(~known, "unknown_type").otherwise(F.coalesce(_first_bad(values, specs[kind]), bad_symbols))
    error = F.when(values.isNull(), "bad_json").otherwise(error)
    return computed_once(parsed, "error", error).withColumn("is_valid", F.col("error").isNull())


def typed_signals(valid: DataFrame, kind: str, keep: Sequence[str] = ()) -> DataFrame:
    """The typed fields of the valid records of one kind."""
    values = F.col("values")
    columns = [_typed(values[n], t).alias(n) for n, t, _ in _signal_fields(kind)]
    if kind == "sector_snapshot":
        entries = F.from_json(values["symbols"], _ENTRIES)
        typed = F.transform(entries, lambda e: F.struct(*[_typed(e[n], t).alias(n) for n, t, _ in _entry_fields()]))
        columns.append(typed.alias("symbols"))
    return valid.filter(F.col("is_valid") & (F.col("signal_type") == kind)).select(*keep, *columns)
