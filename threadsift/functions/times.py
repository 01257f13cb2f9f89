"""Timestamps given as text or as epoch seconds. All times are UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from .sqltext import quote, stripped
from .stage import once

# ISO 8601 date, extended or basic, with an optional time and an optional
# offset. Week dates are not taken.
_ISO = (
    r"(?s)^(?!0000)(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.([01]\d|2[0-3])"
    r"(?:(:?)([0-5]\d)(?:\6([0-5]\d)(?:[.,](\d+))?)?)?"
    r"([+-](?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:\.\d+)?)?)?)?)?$"
)
# offset|date|hour|minute|second|fraction
_LAID_OUT = "$10|$1-$3-$4|$5|$7|$8|$9"


def as_timestamp(when: str | dt.datetime | Column) -> Column:
    """A reference time as a column; naive values are UTC."""
    if isinstance(when, Column):
        return when.cast("timestamp")
    if isinstance(when, dt.datetime):
        if when.tzinfo is not None:
            when = when.astimezone(dt.timezone.utc).replace(tzinfo=None)
        when = when.isoformat(sep=" ")
    return F.lit(f"{when}").cast("timestamp")


def epoch_to_timestamp(c: Column) -> Column:
    """Epoch seconds; anything that is no number gives NULL."""
    return F.timestamp_seconds(c.try_cast("double"))


def iso_string(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")


def instant_steps(source: str, target: str, prefix: str = "_iso") -> list[str]:
    """The instant an ISO 8601 string names, NULL for any other string. A string
    without an offset is UTC. One pass of the pattern lays the parts out."""
    p = prefix

    def two(i: int) -> str:
        return f"if({p}[{i}] = '', '00', {p}[{i}])"

    def seconds(at: int, unit: int) -> str:
        return f"cast(substr({p}_offset, {at}, 2) AS int) * {unit}"

    return [
        f"nullif(replace({stripped(source)}, 'Z', '+00:00'), '') AS {p}_text",
        f"""CASE WHEN {p}_text RLIKE {quote(_ISO)} THEN
            split(regexp_replace({p}_text, {quote(_ISO)}, '{_LAID_OUT}'), '[|]') END AS {p}""",
        f"""try_cast(concat({p}[1], ' ', {two(2)}, ':', {two(3)}, ':', {two(4)}, '.',
            rpad(left({p}[5], 6), 6, '0')) AS timestamp) AS {p}_local""",
        f"rpad(replace({p}[0], ':', ''), 7, '0') AS {p}_offset",
        f"""CASE WHEN {p}[0] = '' THEN 0 ELSE if(startswith({p}[0], '-'), -1, 1) *
            ({seconds(2, 3600)} + {seconds(4, 60)} + {seconds(6, 1)}) END AS {p}_shift""",
        f"timestamp_micros(unix_micros({p}_local) - {p}_shift * 1000000L) AS {target}",
    ]


def with_instant(df: DataFrame, source: str, target: str) -> DataFrame:
    """``df`` with the instant of an ISO 8601 string as a new column. Filters on
    it do not parse the string again."""
    staged = df.selectExpr("*", *instant_steps(source, "_instant"))
    return once(staged.select(*df.columns, "_instant"), {target: F.col("_instant")}).select(
        *df.columns, target
    )


def day_of(ts: Column) -> Column:
    return F.to_date(ts)
