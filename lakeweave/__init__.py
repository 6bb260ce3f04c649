"""lakeweave: a layered lakehouse pipeline expressed as Spark DataFrame jobs.

Sub-packages:
  sources    file and landed-page readers (declarative source specs -> DataFrame)
  sinks      idempotent table loads (full refresh, partition replace, insert overwrite)
  functions  column expressions shared by the layer jobs
  operators  reusable relational building blocks (dimension joins, checks, partition keys)
  plans      the layer jobs (cleansed, curated, reporting), dashboards and the metric API
  streaming  incremental pick-up of newly landed files
"""

__version__ = "0.1.0"
