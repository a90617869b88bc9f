"""Operators put together into whole jobs."""
