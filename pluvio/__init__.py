"""pluvio: rainfall and hazard-event analytics as Spark DataFrame jobs.

Subpackages
-----------
sources    scans, raw station-file ingest and sinks
functions  column-expression helpers (scalar functions)
operators  DataFrame -> DataFrame operators (labels, reports, version
           compare, hourly series, daily features, statistics, spatial,
           evaluation)
plans      stand-in plans over the shared test tables, and their SQL oracles
llm        training-data pipeline operators (nothing else imports it)
"""

from pluvio.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
