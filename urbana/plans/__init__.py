"""Urbana: plans."""
