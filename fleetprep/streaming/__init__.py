"""Saved preparation parameters applied to a stream."""
