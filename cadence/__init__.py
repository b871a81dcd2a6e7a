"""cadence: listening-session analytics on Spark.

Sessions, Discover-Weekly runs, listening runs, early cumulative panes, watermark
replay and late events over play/search events, for batch DataFrames and
Structured Streaming.  See README.md for usage.
"""

__version__ = "0.1.0"
