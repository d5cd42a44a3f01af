"""City analytics on Spark: staging, monthly measures, marts and exports as DataFrame operators."""

from wardline.context import RunContext, build_session

__all__ = ["RunContext", "build_session"]
