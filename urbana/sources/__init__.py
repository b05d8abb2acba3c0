"""Urbana: sources."""
