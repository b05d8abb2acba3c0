"""Urbana: streaming."""
