"""Training-data operators over document tables.

Nothing outside this subpackage imports it. Each operator is a function from
DataFrames to a DataFrame; ``queries`` registers one query per operator.
"""
