"""Urbana: functions."""
