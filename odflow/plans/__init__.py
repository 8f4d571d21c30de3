"""Query catalogue (operators bound to the test tables) and their SQL oracles."""

from odflow.plans.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
