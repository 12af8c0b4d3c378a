"""Whole jobs: the session, the daily run, and the registered queries."""
