"""Genomic interval analytics as Spark DataFrame operators."""

from locusframe.session import get_session

__all__ = ["get_session"]
