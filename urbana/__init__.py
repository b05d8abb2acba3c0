"""Urbana: data operators for city-scale public data, written for Spark."""
