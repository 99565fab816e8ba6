"""Operators for preparing training text: scoring, filtering, matching, mixing and packing.

Nothing outside this subpackage imports it.
"""
