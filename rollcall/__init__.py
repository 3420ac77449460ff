"""rollcall: workforce analytics as Spark jobs.

Operators are functions from DataFrames to a DataFrame. Nothing is read, and
no clock is looked at, inside an operator: tables and the as-of date are
arguments.
"""

__version__ = "0.1.0"
