"""Column expressions shared by the jobs (E1-E11). All are JVM built-ins.

None of them depends on the session time zone: dates of ISO text are taken
as written, and epoch values are turned into UTC dates with integer
arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
S_PER_DAY = 86_400


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- E4: Python-style ``a or b`` (falsy values fall through) ----

def nonzero(x) -> Column:
    """NULL when the value is 0, so ``coalesce`` skips it like Python's ``or``."""
    return F.nullif(_c(x), F.lit(0))


def nonempty(x) -> Column:
    return F.nullif(_c(x), F.lit(""))


def or_numbers(*cols) -> Column:
    """``a or b or ... or last`` for numbers: first non-zero, non-NULL, else the last."""
    cols = [_c(c) for c in cols]
    return F.coalesce(*[nonzero(c) for c in cols[:-1]], cols[-1])


def or_strings(*cols) -> Column:
    """``a or b or ... or last`` for strings: first non-empty, non-NULL, else the last."""
    cols = [_c(c) for c in cols]
    return F.coalesce(*[nonempty(c) for c in cols[:-1]], cols[-1])


# ---- E5: int(x or 0) ----

def int_or_none(x) -> Column:
    """Whole-number value of a counter given as number or text; NULL when unparsable.

    Goes through DECIMAL(38,6) so 5.7 becomes 5 and -5.7 becomes -5 (truncation
    toward zero, like Python's int()).
    """
    s = F.trim(_c(x).cast("string"))
    return F.coalesce(s.try_cast("bigint"),
                      s.try_cast("decimal(38,6)").try_cast("bigint"))


def int_or_zero(x) -> Column:
    """``int(x or 0)``: NULL, empty or unparsable counters become 0."""
    return F.coalesce(int_or_none(x), F.lit(0).cast("bigint"))


def float_or_zero(x) -> Column:
    """``float(x or 0)``."""
    return F.coalesce(F.trim(_c(x).cast("string")).try_cast("double"), F.lit(0.0))


# ---- E8: scalar or {"value": scalar} ----

def scalar_or_value_struct(x) -> Column:
    """A JSON value that is an int or an object ``{"value": int}`` -> the int (0 if neither)."""
    raw = _c(x)
    return int_or_zero(F.coalesce(F.get_json_object(raw, "$.value"), raw))


# ---- E1: post format ----

def infer_format(media_type, status_type) -> Column:
    """Post format from the first attachment's media type and the status type.

    The video test looks at the media type when there is one, else at the
    status; image/album only at the media type; link at either.
    """
    m = F.lower(F.coalesce(_c(media_type), F.lit("")))
    s = F.lower(F.coalesce(_c(status_type), F.lit("")))
    video_probe = F.when(m != "", m).otherwise(s)
    return (
        F.when(video_probe.contains("video"), F.lit("video"))
        .when(m.contains("photo") | m.contains("image"), F.lit("imagen"))
        .when(m.contains("album"), F.lit("carrusel"))
        .when(m.contains("link") | s.contains("shared_story"), F.lit("link"))
        .when(s != "", s)
        .otherwise(F.lit("desconocido"))
    )


# ---- E2 / E3: dates and instants ----

def iso_local_date(text) -> Column:
    """Calendar date of ISO-8601 text as written, in its own offset (no UTC shift)."""
    return F.try_to_date(F.substring(_c(text), 1, 10), "yyyy-MM-dd")


def iso_instant(text) -> Column:
    """Instant of ISO-8601 text with ``Z``, ``+0000`` or ``+00:00`` offsets."""
    return F.try_to_timestamp(_c(text))


def utc_date_of_millis(ms) -> Column:
    return F.date_from_unix_date(F.floor(_c(ms).cast("double") / MS_PER_DAY).cast("int"))


def utc_date_of_seconds(s) -> Column:
    return F.date_from_unix_date(F.floor(_c(s).cast("double") / S_PER_DAY).cast("int"))


def instant_of_millis(ms) -> Column:
    return F.timestamp_millis(_c(ms).cast("bigint"))


def is_digits(text) -> Column:
    return _c(text).rlike("^[0-9]+$")


def epoch_or_iso_date(text) -> Column:
    """TikTok times: text of digits is epoch seconds (UTC date), else ISO text (date as written)."""
    t = _c(text)
    return F.when(is_digits(t), utc_date_of_seconds(t.cast("bigint"))).otherwise(iso_local_date(t))


def epoch_or_iso_instant(text) -> Column:
    t = _c(text)
    return F.when(is_digits(t), F.timestamp_seconds(t.cast("bigint"))).otherwise(iso_instant(t))


# ---- E6: click-through rate ----

def ctr(clicks, impressions) -> Column:
    imp = _c(impressions)
    return F.when(imp > 0, _c(clicks).cast("double") / imp.cast("double") * F.lit(100.0))


# ---- E7 ----

def age_tag(k) -> Column:
    return F.concat(F.lit("AGE."), _c(k))


# ---- E10: date arithmetic ----

def year_start(as_of) -> Column:
    return F.trunc(_c(as_of), "year")


def iso_week_monday(d) -> Column:
    """Monday of the ISO week of a date; one value per ISO (year, week)."""
    d = _c(d)
    return F.date_sub(d, F.weekday(d))
