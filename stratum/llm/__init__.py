"""Operators of a training-data pipeline.

Nothing else in the library imports this subpackage.  Every operator takes
DataFrames and column names and returns DataFrames; ``queries`` registers the
``opN_<name>`` queries on top of them.
"""
