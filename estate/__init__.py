"""estate: bulk file-estate migration analytics on Spark DataFrames.

Every operator takes and returns DataFrames.  Times, totals, thresholds and rule
sets are parameters; nothing reads the clock.
"""

__version__ = "0.1.0"
