"""Market-stream analytics as plain Spark DataFrame operators."""

from tickloom.session import configure

__all__ = ["configure"]
