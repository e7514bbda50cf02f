"""Banking-risk analytics as composable Spark DataFrame operators."""

from riskweave.session import build_session

__all__ = ["build_session"]
