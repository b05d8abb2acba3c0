"""Urbana: operators."""
