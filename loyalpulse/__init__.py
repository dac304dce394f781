"""Survey eligibility and satisfaction forecasting as Spark DataFrame jobs."""

from loyalpulse.context import RunContext

__all__ = ["RunContext"]
