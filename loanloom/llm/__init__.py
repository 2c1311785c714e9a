"""Operators for training-data pipelines: near neighbours, cleaning, deduplication, packing.

Nothing outside this subpackage imports it; ``queries.py`` registers one query per operator.
"""
