"""Small numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def whole_div(column: Column | str, divisor: int | Column) -> Column:
    """Integer division that stays in longs, exact for any size."""
    column = F.col(column) if isinstance(column, str) else column
    divisor = divisor if isinstance(divisor, Column) else F.lit(divisor).cast("long")
    return F.call_function("div", column.cast("long"), divisor)


def epoch_micros(column: Column | str, kind: T.DataType) -> Column:
    """Microseconds since 1970 of a timestamp column of the given type.

    A timestamp without zone is taken as it reads. Casting it would bring in
    the session's time zone, where the hour skipped in spring sorts wrongly.
    """
    column = F.col(column) if isinstance(column, str) else column
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    seconds = (
        F.unix_date(column.cast("date")).cast("long") * 86_400 + F.hour(column) * 3_600 + F.minute(column) * 60
    )
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("long")


def from_epoch_micros(micros: Column, kind: T.DataType) -> Column:
    """The timestamp of the given type that :func:`epoch_micros` turns into ``micros``."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(micros)
    zero = F.lit(0)
    seconds = micros.cast("decimal(20,0)") / F.lit(1_000_000)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))
