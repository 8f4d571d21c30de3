"""Scalar column helpers used by the operators (all built-in Spark expressions)."""

from odflow.functions.columns import (
    PAYMENT_TYPE_LABELS,
    epoch_seconds,
    exact_sum,
    pct,
)

__all__ = ["PAYMENT_TYPE_LABELS", "epoch_seconds", "exact_sum", "pct"]
