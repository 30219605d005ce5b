"""Season analytics over daily station observations and county crop statistics.

Every operator is a function from DataFrames (plus arguments) to a DataFrame, or
from Columns to a Column. Operators are lazy: none of them collects, reads the
clock or stops the session.
"""
