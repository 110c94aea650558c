"""Whole profiling plans and their options."""
