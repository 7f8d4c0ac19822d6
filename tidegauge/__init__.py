"""Spark-native analytics for sensor readings, time series, text and graphs."""

from tidegauge.session import build_session, materialise, shared_folder

__all__ = ["build_session", "materialise", "shared_folder"]
