"""quillspark: claims-pipeline analytics as plain Spark DataFrame operators.

Every public function takes DataFrames (plus plain Python parameters) and
returns a DataFrame (or, for probes, a bool).  Nothing here plans, parses or
schedules queries: Catalyst, AQE and Structured Streaming do that work.
"""

from quillspark.session import build_session, fits_broadcast, work_path  # noqa: F401

__all__ = ["build_session", "fits_broadcast", "work_path"]
