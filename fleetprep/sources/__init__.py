"""Scans, sinks, report files and saved parameters."""
