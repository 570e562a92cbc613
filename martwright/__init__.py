"""Sales marts and everyday table operators, written as plain PySpark.

Sub-packages:

* ``sources``   -- parquet / JDBC readers and the staging step that maps
                   arbitrary tables onto the sales roles.
* ``plans``     -- declared schemas, the three wide datasets, the four marts
                   and the refresh job that publishes them.
* ``operators`` -- table-level operators (thresholds, distinct, neighbour
                   differences, take-until scans, shares, appends).
* ``functions`` -- ``Column`` builders (banding, growth, text repair,
                   messages) and array / map helpers, plus SQL functions.
* ``sinks``     -- full-replace publishing.
* ``streaming`` -- refresh-on-arrival with Structured Streaming.
* ``registry``  -- the registered queries and their SQL oracles.
* ``jobs``      -- command-line entry points (refresh, streaming refresh).
"""

from martwright.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
