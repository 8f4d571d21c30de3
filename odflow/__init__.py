"""odflow: PySpark operators over origin -> destination trip tables.

Profile a table, cut tail outliers by an elbow rule, rank origin/destination
pairs (exactly or with neighbouring zones), and find the longest chain of
linked trips, exactly and in parallel over time slices. Every operator takes
and returns DataFrames; column roles are parameters (``TripRoles``).
"""

from odflow.roles import TAXI, TripRoles
from odflow.session import build_session, ensure_checkpoint_dir

__all__ = ["TAXI", "TripRoles", "build_session", "ensure_checkpoint_dir"]
