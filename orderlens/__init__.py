"""orderlens: order extraction and reconciliation as Spark DataFrame jobs.

Every operator takes and returns lazy DataFrames (or Column expressions); nothing is
collected to the driver except small, size-checked statistics.
"""

__version__ = "0.1.0"
