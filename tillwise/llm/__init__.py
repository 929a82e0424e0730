"""Operators of a training-data pipeline over the tables documents, benchmark and labels.

Nothing outside this folder imports it.
"""
