"""Dimensional modelling on a data lake, expressed as Spark DataFrame jobs."""

__version__ = "0.1.0"
