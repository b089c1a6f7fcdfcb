"""Operators for corpora of training data, their registered queries and the SQL of these."""
