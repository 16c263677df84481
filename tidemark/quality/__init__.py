"""Data-quality checks and the suite that runs them."""

from tidemark.quality.checks import Check
from tidemark.quality.suite import DataQualityError, run, select_checks

__all__ = ["Check", "DataQualityError", "run", "select_checks"]
