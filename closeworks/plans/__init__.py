"""Composite jobs: the monthly books, built from the operators.

Inputs are DataFrames with canonical column names (plain letters, upper case, underscores).
"""
