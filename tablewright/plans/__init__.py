"""Whole batch jobs."""
