"""Idempotent table loads into named layer databases."""

from lakeweave.sinks.tables import Lakehouse
from lakeweave.sinks.files import write_files

__all__ = ["Lakehouse", "write_files"]
