"""Lineage and structure of legacy code estates as Spark DataFrames."""
