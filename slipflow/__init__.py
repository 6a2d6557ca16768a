"""slipflow: contract-document selection, ranking and batching as Spark DataFrame jobs."""

from .config import FIXTURE, REFERENCE, SelectionConfig

__all__ = ["FIXTURE", "REFERENCE", "SelectionConfig"]
