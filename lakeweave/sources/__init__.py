"""Readers: declarative source spec + path -> typed DataFrame."""

from lakeweave.sources.files import read_source, read_layout_lines
from lakeweave.sources.seeds import read_seed

__all__ = ["read_source", "read_layout_lines", "read_seed"]
