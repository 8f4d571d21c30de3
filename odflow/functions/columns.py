"""Column expressions shared by the operators.

All helpers return built-in Spark expressions, so they stay inside whole-stage
code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment-type codes of the trip data and their descriptions; any other
# code is shown as "Unknown code (n)".
PAYMENT_TYPE_LABELS = {
    0: "Flex Fare trip",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}


def epoch_seconds(c: Column) -> Column:
    """Whole seconds since 1970-01-01 of a timestamp (zone-less values read as UTC).

    Sub-second parts are truncated, as ``unix_timestamp`` does.
    """
    return F.unix_timestamp(c)


def pct(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as double; null when ``whole`` is 0 (no division error)."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def exact_sum(c: Column, scale: int | None) -> Column:
    """Sum that does not depend on row order, as DECIMAL(38, scale).

    Every value is kept to ``scale`` decimals (12 by default throughout, more than a double of up to 1,000 holds) and
    the total to 38 - scale whole digits; a larger total raises an error. ``None`` is a plain double sum,
    for values beyond that range.
    """
    if scale is None:
        return F.sum(c.cast("double"))
    return F.sum(c.cast(f"decimal(38,{scale})"))
