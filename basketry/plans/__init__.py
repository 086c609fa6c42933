"""Marts, customer flags and the daily run."""
