"""Day-file naming: ``trading_YYYYMMDD.log`` <-> log_date."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

DAY_FILE_PATTERN = r"trading_(\d{8})\.log"


def date_from_compact(c: str | Column) -> Column:
    """``YYYYMMDD`` text -> DATE; NULL when it is not a real date."""
    return F.try_to_date(col_of(c), "yyyyMMdd")


def date_from_file_name(c: str | Column) -> Column:
    """log_date from a day-file name (or path); NULL when the name has no date."""
    digits = F.regexp_extract(col_of(c), DAY_FILE_PATTERN, 1)
    return date_from_compact(F.nullif(digits, F.lit("")))


def day_file_name(log_date: str | Column) -> Column:
    """DATE -> ``trading_YYYYMMDD.log``."""
    return F.concat(F.lit("trading_"), F.date_format(col_of(log_date), "yyyyMMdd"), F.lit(".log"))


def day_file_for(date_compact: str) -> str:
    """Driver-side name for one run date (``--date`` style argument)."""
    _dt.datetime.strptime(date_compact, "%Y%m%d")
    return f"trading_{date_compact}.log"


def iso_from_compact(date_compact: str) -> str:
    """Unvalidated ``YYYYMMDD`` -> ``YYYY-MM-DD`` slicing, as a run argument."""
    return f"{date_compact[:4]}-{date_compact[4:6]}-{date_compact[6:]}"
