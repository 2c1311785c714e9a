"""Whole flows over named tables, built from the operators."""
