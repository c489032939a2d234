"""rateflow: ratings analytics and recommendation as Spark DataFrame plans.

Subpackages
-----------
sources    -- text loaders and the bindings of the driver's tables to items/ratings/deltas
functions  -- column expressions (year, tag predicates, MinHash, baseline scoring)
operators  -- DataFrame -> DataFrame operators (analytics, averages, deltas, LSH,
              predictors, recommendation)
plans      -- the named query catalogue and its DuckDB oracle SQL
streaming  -- Structured Streaming maintenance of averages from a feed of deltas
"""

from rateflow.session import build_session, checkpoint_dir, scratch_path  # noqa: F401
