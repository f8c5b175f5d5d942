"""PySpark-native point-in-time market-data analytics."""

from lakemart.session import build_session

__all__ = ["build_session"]
