"""shotframe: Spark-native analytics for event fact tables (shot attempts first).

Subpackages:
  sources    - scans, sinks, the shot view over the driver tables
  functions  - scalar column functions (derivations, text shaping)
  operators  - DataFrame -> DataFrame operators (profile, select, aggregate,
               trend, evaluate, features, models, archetypes, path)
  plans      - the end-to-end jobs and the registered queries
  streaming  - incremental ingestion with Structured Streaming
  jobs       - batch entry points for the five reference steps (run_job.py)
"""

__version__ = "0.1.0"
