"""Financial-close reconciliation as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame (or Columns); nothing is
collected to the driver and no Python UDF is used. See README.md for the map of
modules.
"""
