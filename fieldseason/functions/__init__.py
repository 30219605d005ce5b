"""SQL expression texts: calendar windows, exact rounding, weather and crop values.

Each function takes expression texts, mostly column names, and returns one. Generated
lists of expressions reach Spark as text in one call, where building them from Column
objects would cost several calls to the JVM per operation.
"""
