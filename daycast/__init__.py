"""daycast: daily-activity forecasting as Spark DataFrame operators.

Sub-packages:
  functions  scalar column expressions (parsing, calendar, rounding)
  sources    readers, writers and the views over the driver tables
  operators  daily series, imputation, windows, patterns, metrics, splits,
             alerts and scenario overlays
  plans      Spark ML models, recursive forecast, tuning and end-to-end jobs
  streaming  incremental maintenance of the daily series
"""

__version__ = "0.1.0"
