"""Time codes, tags, escapes and byte ranges as column expressions."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Any) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def time_code(t: Any, separator: str = ",") -> Column:
    """Seconds as HH:MM:SS,mmm; milliseconds round half to even, hours grow beyond two digits."""
    ms = F.rint(_c(t) * 1000).cast("long")
    part = lambda by, modulo, n: F.lpad((F.floor(ms / by) % modulo).cast("string"), n, "0")
    hours = F.floor(ms / 3_600_000).cast("string")
    return F.concat(
        F.when(F.length(hours) < 2, F.lpad(hours, 2, "0")).otherwise(hours),
        F.lit(":"), part(60_000, 60, 2), F.lit(":"), part(1000, 60, 2), F.lit(separator), part(1, 1000, 3),
    )


def clock(t: Any) -> Column:
    """mm:ss.ss for display."""
    return F.format_string("%02d:%05.2f", F.floor(_c(t) / 60).cast("long"), _c(t) - 60 * F.floor(_c(t) / 60))


def stripped(text: Any) -> Column:
    """Without white space at both ends, line ends included."""
    return F.regexp_replace(_c(text), r"^\s+|\s+$", "")


def without_tags(text: Any) -> Column:
    return F.regexp_replace(_c(text), "</?[^>]+>", "")


def without_mark(text: Any) -> Column:
    """Without a byte-order mark and carriage returns."""
    return F.regexp_replace(_c(text), "^﻿|\r", "")


def html_escaped(text: Any) -> Column:
    out = _c(text)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def short_sha1(content: Any) -> Column:
    """The first 16 hex digits of SHA-1."""
    return F.substring(F.sha1(_c(content)), 1, 16)


def byte_range(header: Any, size: Any) -> Column:
    """(first, last) bytes that an HTTP Range header asks of a file of size bytes, both inclusive; null if it can't be met.

    bytes=a-b, bytes=a- and bytes=-n are known; the last one asks for the last n bytes."""
    a, b = (F.regexp_extract(_c(header), r"^bytes=(\d*)-(\d*)$", i) for i in (1, 2))
    first = F.when(a != "", F.try_to_number(a, F.lit("999999999999999999")).cast("long")).when(b != "", F.greatest(_c(size) - F.try_to_number(b, F.lit("999999999999999999")).cast("long"), F.lit(0)))
    last = F.when((a != "") & (b != ""), F.least(F.try_to_number(b, F.lit("999999999999999999")).cast("long"), _c(size) - 1)).otherwise(_c(size) - 1)
    return F.when((first <= last) & (first < _c(size)), F.struct(first.alias("first"), last.alias("last")))


def pcm16(x: Any) -> Column:
    """A sample between -1 and 1 as a 16-bit integer; what lies outside is clipped, fractions are cut off."""
    return (F.least(F.greatest(_c(x).cast("double"), F.lit(-1.0)), F.lit(1.0)) * 32767).cast("smallint")


def tick_step(seconds_for_pixel: Any, steps: list[float], last: float = 600.0) -> Column:
    """The first of steps that keeps a dozen ticks or fewer in view."""
    out = F.lit(last)
    for s in reversed(steps):
        out = F.when(_c(seconds_for_pixel) / s <= 12, F.lit(float(s))).otherwise(out)
    return out


def data_uri(kind: str, data: Column) -> Column:
    """Bytes as a data URI of a media type, in one line."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.regexp_replace(F.base64(data), "\\s", ""))
