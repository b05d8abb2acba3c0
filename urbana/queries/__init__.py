"""Urbana: queries."""
