"""Hitloom: turns raw web-analytics hit exports into event tables on Spark.

Every operator is a function from DataFrames to a DataFrame. Nothing runs until
a layer is written or a report is collected, so Catalyst sees one plan.
"""

from hitloom.config import Settings
from hitloom.session import build_session

__all__ = ["Settings", "build_session"]
