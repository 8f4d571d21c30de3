"""Operators: profile, quantiles, outliers, pairs, chain."""

from odflow.operators import chain, outliers, pairs, profile, quantiles

__all__ = ["chain", "outliers", "pairs", "profile", "quantiles"]
