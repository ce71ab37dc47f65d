"""Dimensional-warehouse operators for PySpark.

Every operator takes DataFrames and column names and returns a DataFrame, so the
same code serves the star schema in ``starloom.plans`` and any other tables.
"""
