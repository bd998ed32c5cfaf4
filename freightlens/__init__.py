"""freightlens: procurement and service-level analytics for freight providers on PySpark.

Every operator is a function from DataFrames to a DataFrame.  Nothing is
collected to the driver; Catalyst plans the whole chain.
"""

__version__ = "0.1.0"
