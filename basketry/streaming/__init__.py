"""Envelope streams into RAW and mart tables."""
