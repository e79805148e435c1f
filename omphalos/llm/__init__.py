"""Operators of a training-data pipeline: filtering, deduplication, token work.

Nothing else in the library imports this subpackage; ``entries`` holds its
registered queries.
"""
