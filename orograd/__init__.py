"""Degree-day and low-level weather analytics as DataFrame -> DataFrame operators."""
