"""Request pacing as pure functions over attempts; nothing here waits or asks the network."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_BACKOFF = 300
ATTEMPTS = 3
# Statuses that end a run, and those that are tried again.
STOPPING = (401, 403, 429)
AGAIN = (500, 502, 503, 504)


def effective_delay(configured: Column, crawl_delay: Column, seconds: Column, requests: Column) -> Column:
    """The largest of the configured delay, the crawl delay and seconds per request."""
    return F.greatest(configured.cast("double"), crawl_delay.cast("double"), (seconds / requests).cast("double"))


def backoff_wait(retry_after: Column, now: Column, least: int = LEAST_BACKOFF) -> Column:
    """Seconds to wait after a refusal: the header's seconds, or its date less now; least if it has neither or less."""
    seconds = F.try_to_number(F.when(retry_after.rlike(r"^\d{1,9}$"), retry_after), F.lit("999999999")).cast("bigint")
    at = F.try_to_timestamp(F.regexp_replace(retry_after, r"^\w{3}, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.greatest(F.lit(least).cast("bigint"), F.coalesce(seconds, F.unix_timestamp(at) - F.unix_timestamp(now), F.lit(least)))


def retry_wait(attempt: Column, primary: Column) -> Column:
    """Seconds before try attempt + 2 (attempt counts from 0): doubling for the primary source, in steps of ten for the archive."""
    return F.when(primary, F.pow(F.lit(2), attempt + 1)).otherwise(10 * (attempt + 1)).cast("bigint")


def status_class(status: Column, has_retry_after: Column, attempt: Column, attempts: int = ATTEMPTS) -> Column:
    """ok, stop, retry or raise."""
    last = attempt >= attempts - 1
    return F.when(status.isin(*STOPPING) | ((status >= 500) & (has_retry_after | last)), "stop").when(status.isin(*AGAIN), "retry").when(status == 200, "ok").otherwise("raise")


def schedule(attempts: DataFrame, by: str, order: str, took: str, delay: float, burst_size: int, burst_pause: float) -> DataFrame:
    """(by, order, start): when each attempt starts if it may as soon as the pacing allows.

    An attempt starts delay after the last one's start, and after a full burst no sooner than burst_pause
    after its last one's end. Since each start depends only on the one before, it is a sum: of the
    delay, or at a burst's end of the larger of the delay and the attempt's time plus the pause.
    """
    if not (math.isfinite(delay) and delay >= 0 and math.isfinite(burst_pause) and burst_pause >= 0 and burst_size >= 1):
        raise ValueError("delays must be finite and not negative, and a burst at least one")
    from pyspark.sql import Window

    w = Window.partitionBy(by).orderBy(order)
    step = F.when(F.row_number().over(w) % burst_size == 0, F.greatest(F.lit(delay), F.col(took) + burst_pause)).otherwise(F.lit(delay))
    start = F.coalesce(F.sum("__step").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return attempts.withColumn("__step", step).select(by, order, start.alias("start"))
