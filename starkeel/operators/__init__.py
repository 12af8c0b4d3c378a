"""Operators: plain DataFrame transformations, generic over keys and columns."""
