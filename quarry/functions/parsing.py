"""Field splitting and value parsing for line-oriented inputs.

Two split dialects exist in the source jobs:
  * Java ``String.split``: trailing empty fields are dropped (``"1,T,"`` has 2
    fields, ``""`` has 1 empty field, ``",,"`` has none);
  * Python ``str.split``: every field is kept.
Both split on a literal separator here.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(line: ColumnOrName, sep: str = ",", drop_trailing_empty: bool = False) -> Column:
    """Split on a literal separator.  ``drop_trailing_empty`` gives Java semantics."""
    c = _col(line)
    if not drop_trailing_empty:
        return F.split(c, re.escape(sep))
    # Java: trailing empty fields are dropped, i.e. trailing separators do not
    # count; a line made only of separators has no field at all, while an
    # empty line keeps its single empty field.
    if len(sep) == 1:
        stripped = F.rtrim(c, F.lit(sep))
    else:
        stripped = F.regexp_replace(c, "(?:" + re.escape(sep) + ")+$", "")
    return F.when((stripped == "") & (c != ""), F.array().cast("array<string>")) \
            .otherwise(F.split(stripped, re.escape(sep)))


# Java String.trim strips every character from U+0000 to U+0020.
_JAVA_SPACE = "".join(chr(i) for i in range(0x21))


def java_trim(value: ColumnOrName) -> Column:
    """Java ``String.trim``: strips every character up to U+0020 (tabs, CR, ...)
    from both ends, not only spaces.  The common case (only spaces around the
    text) takes the fast space trim; the character-set trim runs only when a
    control character is left at either end."""
    c = _col(value)
    fast = F.trim(c)
    edge = (F.ascii(fast) < 33) | (F.substring(fast, -1, 1) < F.lit("!"))
    return F.when(edge & (fast != F.lit("")), F.trim(c, F.lit(_JAVA_SPACE))).otherwise(fast)


def field(parts: ColumnOrName, index: int, trim: bool = False) -> Column:
    """0-based field; null when the line is too short."""
    v = F.try_element_at(_col(parts), F.lit(index + 1))
    return java_trim(v) if trim else v


def strict_field(parts: ColumnOrName, index: int, what: str = "field") -> Column:
    """0-based field; fails the job when the line is too short (fail-fast jobs)."""
    p = _col(parts)
    return F.when(F.size(p) > index, F.get(p, index)).otherwise(
        F.raise_error(F.concat(F.lit(f"missing {what}: "), F.array_join(p, ",", ""))).cast("string"))


def last_field(parts: ColumnOrName, trim: bool = False) -> Column:
    v = F.try_element_at(_col(parts), F.lit(-1))
    return java_trim(v) if trim else v


def middle_join(parts: ColumnOrName, sep: str = ",") -> Column:
    """``sep.join(parts[1:-1])``: a title that itself contains the separator."""
    p = _col(parts)
    return F.array_join(F.slice(p, 2, F.greatest(F.size(p) - 2, F.lit(0))), sep)


def try_number(value: ColumnOrName, to: str = "double") -> Column:
    """Parse or null (skip-on-error jobs filter the nulls out)."""
    return _col(value).try_cast(to)


def strict_number(value: ColumnOrName, to: str = "double", what: str = "value") -> Column:
    """Parse or fail the job, whatever the session's ANSI setting (fail-fast jobs)."""
    v = _col(value)
    parsed = v.try_cast(to)
    return F.when(parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"cannot parse {what}: "),
                                         F.coalesce(v.cast("string"), F.lit("<missing>"))))
                  ).otherwise(parsed).cast(to)


# Calendar range representable as a Spark date (years 1..9999), in epoch seconds.
_MIN_EPOCH = -62135596800
_MAX_EPOCH = 253402300799


def epoch_year(seconds_text: ColumnOrName) -> Column:
    """Calendar year (UTC) of an epoch-seconds text; null when unparsable or out
    of range.  Works on whole days, so it does not depend on the session zone."""
    secs = _col(seconds_text).try_cast("bigint")
    ok = secs.between(_MIN_EPOCH, _MAX_EPOCH)
    day = F.floor(secs / F.lit(86400)).cast("int")
    return F.when(ok, F.year(F.date_from_unix_date(day)))


def to_timestamp_any(df: DataFrame, name: str,
                     formats: tuple[str, ...] = ("yyyy-MM-dd HH:mm", "yyyy-MM-dd HH:mm:ss")) -> Column:
    """Timestamp from a column that may already be a timestamp (identity), a date,
    or text in one of ``formats`` (first match wins, unparsable -> null)."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(dtype, T.DateType):
        return c.cast("timestamp")
    return F.coalesce(*[F.try_to_timestamp(c.cast("string"), F.lit(f)) for f in formats])


def parsed_once(df: DataFrame, *columns: Column) -> DataFrame:
    """``df.select(*columns)``, but emitted by a generator so the parsed values
    are computed once: filters on them stay above the generator instead of
    being pushed below the projection with the parsing expression copied into
    every condition (text splits, JSON extraction, casts)."""
    return df.select(F.inline(F.array(F.struct(*columns))))
