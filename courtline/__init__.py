"""courtline: a Spark-native box-score feature pipeline.

Nested per-game JSON documents are normalised into team, player, game and
box-score tables, and leakage-free training features are computed from them
with DataFrame operations only.  See README.md for the module map.
"""

from courtline.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
