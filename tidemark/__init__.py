"""Coastal flood damage and population impact on Spark DataFrames."""

from tidemark.session import get_session

__all__ = ["get_session"]
