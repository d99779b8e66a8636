"""Date columns: parsing, ages, buckets, freshness. `now` is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse

_FORMS = ("d MMM yyyy HH:mm:ss z", "d MMM yyyy H:mm:ss z", "d MMM yyyy HH:mm:ss Z", "d MMM yyyy H:mm:ss Z", "d MMM yyyy HH:mm z", "d MMM yyyy HH:mm Z", "d MMM yyyy")
ARCHIVAL_DAYS = 60


def parse_date(value: Column) -> Column:
    """ISO 8601 or RFC 2822 as a timestamp; a date without a zone is UTC in a UTC session; anything else null."""
    own = collapse(value)
    bare = F.regexp_replace(own, r"^[A-Za-z]{3},\s*", "")
    iso = F.when(own.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(own))
    return F.coalesce(iso, *(F.when(bare.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4}"), F.try_to_timestamp(bare, F.lit(f))) for f in _FORMS))


def micros(ts: Column) -> Column:
    """Microseconds since 1970, also of a timestamp without zone, which then is in the session's."""
    return F.unix_micros(ts.cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    return F.coalesce(F.unix_timestamp(ts), F.lit(0))


def age_days(ts: Column, now: Column) -> Column:
    return (micros(now) - micros(ts)) / F.lit(86400e6)


def whole_days(ts: Column, now: Column) -> Column:
    """The age rounded half to even."""
    return F.bround(age_days(ts, now), 0).cast("int")


def relative_age(ts: Column, now: Column) -> Column:
    """future, today, yesterday, or whole days, months of 30 days, or years of 365; empty for null."""
    d = age_days(ts, now)
    of = lambda n, unit: F.concat(F.floor(d / n).cast("string"), F.lit(unit))
    return F.when(d.isNull(), "").when(d < 0, "future").when(d < 1, "today").when(d < 2, "yesterday").when(d < 30, of(1, " d")).when(d < 365, of(30, " mo")).otherwise(of(365, " y"))


def is_archival(ts: Column, now: Column) -> Column:
    return F.coalesce(age_days(ts, now) >= ARCHIVAL_DAYS, F.lit(False))


def format_date(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "dd/MM/yyyy 'à' HH:mm 'UTC'"), F.lit(""))


def is_stale(ts: Column, now: Column, ttl_seconds: int) -> Column:
    """Whether the time to live is over; a null time is stale."""
    return F.coalesce(micros(now) - micros(ts) >= ttl_seconds * 1_000_000, F.lit(True))
