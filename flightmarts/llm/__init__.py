"""Operators for a training-data pipeline: one module per operator.

``queries`` registers them; nothing outside this subpackage imports it.
"""
