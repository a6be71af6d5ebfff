"""offerweave: multi-source job-offer analytics as PySpark DataFrame jobs."""

from offerweave.session import get_spark

__all__ = ["get_spark"]
