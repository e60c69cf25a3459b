"""Monthly batch analytics over trip records and weather observations, on Spark.

Layers: raw (bronze), cleaned (silver), feature tables (gold).  Every operator
maps DataFrames to a DataFrame or Columns to a Column and stays lazy; only the
writers in ``sources.lake`` and the jobs in ``plans`` run Spark actions.
"""
