"""Small column expressions."""

from __future__ import annotations

from datetime import date, datetime, time
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(x: Column, digits: int) -> Column:
    """Round half to even.

    Sums of doubles differ in their last bits with the order of addition. Rounding to 9 places first
    removes that noise, so a decimal tie is decided the same way on every run.
    """
    return F.bround(F.bround(x, 9), digits)




def bucket(x: str, width: int) -> Column:
    """``x div width`` for epoch milliseconds and row numbers, which are never negative."""
    return F.expr(f"`{x}` div {int(width)}L")


def arrival_order(offset: Column, seq: Column, span: int) -> Column:
    """``(offset, seq)`` as one whole number, for ``0 <= offset < span``.

    Ordering by a number instead of a struct lets Spark aggregate by hash, without sorting its input first.
    The bits that the offset leaves free must hold the arrival number: 47 for a minute, 44 for five.
    """
    room = 63 - (span - 1).bit_length()
    packed = F.shiftleft(offset, room) + seq
    return F.when(seq.between(0, 2**room - 1), packed).otherwise(
        F.raise_error(F.lit(f"arrival numbers must lie between 0 and 2^{room}"))
    )


def ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def ts_to_ms(ts: str | Column) -> Column:
    return F.unix_millis(ts)


def ms_to_iso(ms: Column) -> Column:
    """``2024-01-01T00:00:00.000Z``"""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def ms_to_iso_seconds(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_to_ts(text: Column) -> Column:
    """ISO text to a timestamp cut to milliseconds; null for text that is no timestamp."""
    return F.date_trunc("millisecond", F.try_to_timestamp(text))


def pct_change(first: Column, last: Column) -> Column:
    """Percent change, 0 where the first price is 0."""
    return F.when(first != 0, (last - first) / first * 100).otherwise(F.lit(0.0))


def signal_score(signal_type: Column, strength: Column) -> Column:
    """1..10 from the strength; a kind's unit of strength is worth one point, other kinds score 5."""
    # The units.
    unit = (
        F.when(signal_type == "volume_spike", F.lit(0.5))
        .when(signal_type == "volatility_spike", F.lit(0.3))
        .when(signal_type == "momentum_signal", F.lit(0.15))
    )
    points = (F.when(signal_type == "momentum_signal", F.abs(strength)).otherwise(strength) / unit).cast("int")
    return F.when(unit.isNull(), F.lit(5)).otherwise(F.greatest(F.lit(1), F.least(F.lit(10), points)))


def two_places_or_na(x: Column) -> Column:
    return F.coalesce(F.format_number(x, 2), F.lit("N/A"))


def ts_literal(at: datetime) -> Column:
    """A timestamp literal; a naive datetime is UTC, whatever the zones of the driver and the session."""
    at = at.replace(tzinfo=ZoneInfo("UTC")) if at.tzinfo is None else at.astimezone(ZoneInfo("UTC"))
    return F.lit(at.strftime("%Y-%m-%dT%H:%M:%S.%fZ")).cast("timestamp")


def clock_on(day: date, clock: str, tz: str) -> datetime:
    """The instant of a wall-clock time on a day in a zone."""
    return datetime.combine(day, time.fromisoformat(clock), ZoneInfo(tz))
