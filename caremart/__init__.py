"""Star-schema loads and occupancy forecasts for hospital extracts, on Spark DataFrames."""

from caremart.session import build_session

__all__ = ["build_session"]
