"""Time-series features, forecasts, monitoring and leaderboards as Spark jobs."""

from tidegrid.grid import Grid

__all__ = ["Grid"]
