"""Column expressions on time: days, operating windows, delays, retries, estimates. ``now`` is always given."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
#: Ids that planning takes a second, as estimates assume.
PLANNED_PER_SECOND = 50


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def utc_day(ts: Column | str) -> Column:
    return F.to_date(_col(ts))


def next_utc_day(ts: Column | str) -> Column:
    return F.date_trunc("DAY", _col(ts)) + F.expr("INTERVAL 1 DAY")


def in_window(ts: Column | str, start: Column | str, end: Column | str) -> Column:
    """Whether the hour lies in [start, end), which may wrap round midnight; null or equal ends allow every hour."""
    h, s, e = F.hour(_col(ts)), _col(start), _col(end)
    inside = F.when(s < e, (h >= s) & (h < e)).otherwise((h >= s) | (h < e))
    return F.when(s.isNull() | e.isNull() | (s == e), True).otherwise(inside)


def window_opens(ts: Column | str, start: Column | str) -> Column:
    """When the window that begins at hour ``start`` opens next."""
    t = _col(ts)
    today = F.date_trunc("DAY", t) + F.make_dt_interval(F.lit(0), _col(start).cast("int"))
    return F.when(today > t, today).otherwise(today + F.expr("INTERVAL 1 DAY"))


def retry_delay_ms(attempts: Column | str, jitter: Column | float = 0.5) -> Column:
    """Backoff after a failed attempt: doubling from a minute to six hours, times 0.8 to 1.2."""
    j = jitter if isinstance(jitter, Column) else F.lit(float(jitter))
    plain = F.least(F.lit(21_600_000.0), F.greatest(F.lit(60_000.0), F.pow(F.lit(2.0), F.greatest(F.lit(0), _col(attempts) - 1)) * 60_000.0))
    return F.round(plain * (F.lit(0.8) + F.lit(0.4) * j)).cast("bigint")


def http_retry_ms(attempt: Column | str, minimum: Column | str, retry_after: Column | str | None = None, now: Column | None = None) -> Column:
    """Delay before a request is sent again: what the server asks for (seconds or a date), else doubling
    seconds up to five minutes; never less than the source's minimum."""
    own = F.least(F.lit(300_000.0), F.pow(F.lit(2.0), _col(attempt)) * 1000.0)
    if retry_after is None:
        return F.greatest(_col(minimum).cast("double"), own).cast("bigint")
    asked = _col(retry_after)
    seconds = F.when(asked.rlike(r"^\d+$"), asked.try_cast("double") * 1000.0)
    at = F.try_to_timestamp(asked, F.lit("EEE, dd MMM yyyy HH:mm:ss z"))
    wait = F.greatest(F.lit(0.0), (F.unix_millis(at) - F.unix_millis(now)).cast("double")) if now is not None else F.lit(None).cast("double")
    return F.greatest(_col(minimum).cast("double"), F.coalesce(seconds, wait, own)).cast("bigint")


def is_retryable(status: Column | str) -> Column:
    s = _col(status)
    return (s == 429) | (s == 503) | (s >= 500)


def availability_of(status: Column | str) -> Column:
    s = _col(status)
    return F.when(s == 404, "not_found").when(s == 403, "restricted").otherwise("unavailable")


def failure_code(status: Column | str) -> Column:
    s = _col(status)
    return F.when(s.isNotNull(), F.concat(F.lit("http_"), s.cast("string"))).otherwise("network_failed")


def pace_ms(minimum_delay_ms: Column | str, daily_requests: Column | str) -> Column:
    """Milliseconds that a request takes on average under the delay and the daily budget (null: none)."""
    per_day = F.try_divide(F.lit(float(DAY_MS)), F.nullif(_col(daily_requests), F.lit(0)))
    return F.greatest(_col(minimum_delay_ms).cast("double"), F.coalesce(per_day, F.lit(0.0)))


def collect_eta_ms(count: Column | str, minimum_delay_ms: Column | str, daily_requests: Column | str) -> Column:
    return _col(count) * pace_ms(minimum_delay_ms, daily_requests)


def planning_eta_ms(count: Column | str) -> Column:
    return _col(count) / F.lit(float(PLANNED_PER_SECOND)) * 1000.0


def unlimited(value: Column | str) -> Column:
    """Zero stands for no limit."""
    return F.nullif(_col(value), F.lit(0))


def progress_percent(done: Column | str, total: Column | str) -> Column:
    return F.when(_col(total) > 0, F.round(F.lit(100.0) * _col(done) / F.nullif(_col(total), F.lit(0)), 2)).otherwise(0.0)


def remaining_ms(elapsed: Column | str, done: Column | str, total: Column | str) -> Column:
    """Time that the rest takes at the pace so far; null before anything is done."""
    d = F.nullif(_col(done), F.lit(0))
    return _col(elapsed) / d * F.greatest(F.lit(0), _col(total) - _col(done))


def duration_text(ms: Column | str) -> Column:
    """Hours, minutes and seconds."""
    s = F.floor(_col(ms) / 1000).cast("bigint")
    return F.when(s >= 3600, F.concat(F.floor(s / 3600).cast("string"), F.lit("h "), F.floor(s % 3600 / 60).cast("string"), F.lit("m"))).when(
        s >= 60, F.concat(F.floor(s / 60).cast("string"), F.lit("m "), (s % 60).cast("string"), F.lit("s"))
    ).otherwise(F.concat(s.cast("string"), F.lit("s")))


def long_duration_text(ms: Column | str) -> Column:
    """The one unit that fits, rounded up: minutes below an hour, hours below two days, days below a year, else years."""
    minutes = F.ceil(_col(ms) / 60_000)
    hours, days = minutes / 60, minutes / 1440
    return (
        F.when(minutes < 60, F.concat(minutes.cast("string"), F.lit(" min"))).when(hours < 48, F.concat(F.ceil(hours).cast("string"), F.lit(" h")))
        .when(days < 365, F.concat(F.ceil(days).cast("string"), F.lit(" days"))).otherwise(F.concat(F.format_string("%.1f", days / 365), F.lit(" years")))
    )


def byte_text(size: Column | str) -> Column:
    """Bytes in the largest unit up to GB of which there is at least one; a decimal place from KB on."""
    n = _col(size).cast("double")
    text = F.concat(F.format_string("%.0f", n), F.lit(" B"))
    for k, unit in enumerate(("KB", "MB", "GB"), 1):
        text = F.when(n >= 1024.0**k, F.concat(F.format_string("%.1f", n / 1024.0**k), F.lit(f" {unit}"))).otherwise(text)
    return text
