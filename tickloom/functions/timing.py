"""Unix-millisecond arithmetic. Nothing here depends on the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schema import DAY_MS



def bucket_start(ts_ms: Column, size_ms: int) -> Column:
    """Floor to a multiple of ``size_ms``, also for times before 1970."""
    return ts_ms - F.pmod(ts_ms, F.lit(size_ms).cast("long"))


def utc_date(ts_ms: Column) -> Column:
    days = F.call_function("div", bucket_start(ts_ms, DAY_MS), F.lit(DAY_MS).cast("long"))
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def date_ms(date: Column) -> Column:
    """Unix ms of midnight UTC."""
    return F.unix_date(date).cast("long") * F.lit(DAY_MS)


def month_key(start_ms: Column) -> Column:
    """``YYYYMM``. Milliseconds are cut toward zero first, as the table's writers do."""
    whole_seconds = F.call_function("div", start_ms, F.lit(1000).cast("long"))
    date = utc_date(whole_seconds * F.lit(1000))
    return (F.year(date) * 100 + F.month(date)).cast("int")


def iso_utc(ts_ms: Column) -> Column:
    """ISO 8601 with a UTC offset; the fraction shows only when there is one."""
    in_day = F.pmod(ts_ms, F.lit(DAY_MS).cast("long"))
    seconds = F.call_function("div", in_day, F.lit(1000).cast("long"))
    millis = F.pmod(ts_ms, F.lit(1000).cast("long"))
    clock = F.format_string(
        "%02d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60
    )
    fraction = F.when(millis == 0, F.lit("")).otherwise(F.format_string(".%03d000", millis))
    return F.concat(utc_date(ts_ms).cast("string"), F.lit("T"), clock, fraction, F.lit("+00:00"))
