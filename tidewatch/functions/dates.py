"""Timestamp parsing in the accepted date layouts."""

from pyspark.sql import Column, functions as F

# Accepted layouts, tried in this order.
YEAR_FIRST_DASH = "yyyy-M-d H:m:s[.SSSSSS]"
DAY_FIRST_SLASH = "d/M/yyyy H:m:s[.SSSSSS]"
YEAR_FIRST_SLASH = "yyyy/M/d H:m:s"
MONTH_FIRST_SLASH = "M/d/yyyy H:m:s"


def single_spaced(text: Column) -> Column:
    return F.when(text.rlike(r"\s\s|[\t\n]"), F.regexp_replace(text, r"\s+", " ")).otherwise(text)


def parse_timestamp(text: Column) -> Column:
    """The time in a trimmed, single-spaced text; null when no layout fits.

    A failed attempt costs an exception per row, so the layout is picked by the
    shape of the text: day-first and month-first dates can only both fit when
    the second number is a month, and then day-first has priority.
    """
    by = lambda layout: F.try_to_timestamp(text, F.lit(layout))
    return (
        F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2} "), by(YEAR_FIRST_DASH))
        .when(text.rlike(r"^\d{1,2}/(1[3-9]|[2-9]\d)/"), by(MONTH_FIRST_SLASH))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/"), by(DAY_FIRST_SLASH))
        .when(text.rlike(r"^\d{4}/\d{1,2}/\d{1,2} "), by(YEAR_FIRST_SLASH))
    )
