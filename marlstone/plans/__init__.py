"""Whole plans: the nightly run, and the registered queries with their SQL."""
