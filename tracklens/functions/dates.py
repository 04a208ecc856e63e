from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracklens.constants import RUN_TIME_ZONE


def run_date(ts: Column, zone: str = RUN_TIME_ZONE, instant: bool = True) -> Column:
    """The ``YYYYMMDD`` day on which a timestamp falls in ``zone``.

    ``instant`` tells a TIMESTAMP, a point in time, from a TIMESTAMP_NTZ, which is
    read as a UTC clock. The session's zone has no influence on either.
    """
    if instant:
        # Micros and not a cast: a cast would pass through the session's clock.
        seconds = F.unix_micros(ts) / F.lit(1_000_000).cast("decimal(18,0)")
        zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        zeros = [F.lit(0)] * 3
        ts = zero + F.make_dt_interval(*zeros, seconds.cast("decimal(18,6)"))
    there = F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
    return F.date_format(there.cast("date"), "yyyyMMdd")


def today(zone: str = RUN_TIME_ZONE) -> str:
    """The current day in ``zone`` as ``YYYYMMDD``."""
    return datetime.now(ZoneInfo(zone)).strftime("%Y%m%d")
