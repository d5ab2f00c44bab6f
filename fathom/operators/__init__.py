"""Reusable DataFrame -> DataFrame operators.

Everything here composes built-in Spark operators (joins, aggregates,
windows, scalar subqueries); none of it needs a Python UDF.
"""
