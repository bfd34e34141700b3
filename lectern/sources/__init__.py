"""Scans, sinks and scratch space."""
