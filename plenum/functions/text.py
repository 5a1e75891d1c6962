"""Text expressions used by sources and chart labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_segment(url: Column) -> Column:
    """Part of a URL or path after its last slash."""
    return F.element_at(F.split(url, "/"), -1)


def stem(filename: Column) -> Column:
    """File name without its last extension; leading dots do not start an extension."""
    return F.regexp_replace(filename, r"^(.*[^.].*)\.[^.]*$", "$1")


def capitalised(text: Column) -> Column:
    """First letter upper, all others lower."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1 << 30)))


def words(name: Column) -> Column:
    """Field name as an axis title: underscores become spaces, then :func:`capitalised`."""
    return capitalised(F.replace(name, F.lit("_"), F.lit(" ")))


def percent_text(share: Column, decimals: int) -> Column:
    """Percentage with fixed decimals and a percent sign; exact ties go to the even digit."""
    return F.concat(F.format_number(share, decimals), F.lit("%"))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, or 0 when the denominator is not positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator).otherwise(F.lit(0.0))
