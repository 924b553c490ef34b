"""Severity and message of an alert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def severity(value: Column, lower: Column, upper: Column) -> Column:
    """Distance to the nearest bound in units of the interval width; NULL at width zero."""
    distance = F.when(value < lower, lower - value).otherwise(value - upper)
    return F.try_divide(distance, upper - lower)


def alert_message(value: Column, lower: Column, upper: Column, digits: int | None = None) -> Column:
    """Text stored with an alarm; ``digits`` rounds both numbers."""

    def text(number: Column) -> Column:
        return (number if digits is None else F.round(number, digits)).cast("string")

    return F.concat(
        F.lit("Value "),
        text(value),
        F.lit(" outside of confidence interval by "),
        F.coalesce(text(severity(value, lower, upper)), F.lit("NaN")),
    )
