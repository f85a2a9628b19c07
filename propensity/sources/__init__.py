"""Scans, sinks and the run ledger."""
