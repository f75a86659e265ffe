"""wattframe: Spark-native analytics over half-hourly generation per unit.

Every public function maps DataFrames to DataFrames; nothing runs at import
time and nothing is collected to the driver except small scalar checks
(size guards before a broadcast).
"""

from wattframe.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
