"""Operators on text and on pairs of records, for training data. Nothing outside this subpackage imports it."""
