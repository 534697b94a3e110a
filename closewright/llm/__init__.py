"""Operators for preparing training text: one module per operator, `queries` and `sql` for the registered queries.

Nothing outside this package imports it. Every operator takes and returns DataFrames; Spark partitions and
shuffles the work, and numpy or Arrow run inside tasks only on the rows of that task.
"""
