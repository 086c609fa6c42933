"""Retail customer analytics as Spark jobs: documents -> RAW -> marts -> customer flags."""
