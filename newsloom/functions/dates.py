"""Date readers. Values that cannot be read become NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import strip

ISO_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S][XXX]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S][XXX]",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "yyyyMMdd",
)
WEEKDAY = "^[A-Za-z]{3,9},[ ]*"


def _try(c: Column, fmt: str) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def mixed_timestamp(c: Column) -> Column:
    """One column, several ISO spellings; each value is read on its own."""
    text = strip(c)
    return F.coalesce(*[_try(text, f) for f in ISO_FORMATS])


def rfc822_timestamp(c: Column, default: Column | None = None) -> Column:
    """`Sat, 26 Apr 2025 10:00:00 +0000` to UTC; weekday optional."""
    text = F.regexp_replace(strip(c), WEEKDAY, "")
    text = F.regexp_replace(text, "(GMT|UTC|UT|Z)$", "+0000")
    read = F.coalesce(_try(text, "d MMM yyyy HH:mm:ss Z"), _try(text, "d MMM yyyy HH:mm Z"))
    return read if default is None else F.coalesce(read, default)


def compact_timestamp(c: Column, default: Column | None = None) -> Column:
    """`20250426T100000Z`."""
    read = _try(c, "yyyyMMdd'T'HHmmssX")
    return read if default is None else F.when(F.coalesce(c, F.lit("")) == "", default).otherwise(read)


def compact_to_iso(c: Column, now: Column) -> Column:
    """Text form of `compact_timestamp`: empty becomes now, unreadable stays as it is."""
    return F.when(F.coalesce(c, F.lit("")) == "", iso(now)).otherwise(
        F.coalesce(iso(compact_timestamp(c)), c)
    )


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
