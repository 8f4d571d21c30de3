"""Column roles: which column of a table plays origin, destination, times, amounts.

Every role is a column name or a Column expression, so the operators run on
any table (a taxi month, or ``lineitem`` with ``l_suppkey % 50 + 1`` as
origin). ``project`` selects only the roles an operator needs under fixed
names, so column pruning reaches the Parquet scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

@dataclass(frozen=True)
class TripRoles:
    origin: object = "PULocationID"
    dest: object = "DOLocationID"
    start: object = "tpep_pickup_datetime"
    end: object = "tpep_dropoff_datetime"
    distance: object = "trip_distance"
    amount: object = "total_amount"
    id: object = None

    def col(self, role: str) -> Column:
        value = getattr(self, role)
        if value is None:
            raise ValueError(f"role '{role}' is not bound")
        return F.col(value) if isinstance(value, str) else value

    def project(self, df: DataFrame, roles: list[str], keep: list[str] | None = None) -> DataFrame:
        """Select the given roles, named after the role, plus ``keep`` columns."""
        cols = [self.col(r).alias(r) for r in roles]
        cols += [F.col(c) for c in (keep or [])]
        return df.select(*cols)


TAXI = TripRoles()
