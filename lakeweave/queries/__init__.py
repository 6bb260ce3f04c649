"""Query keys, grouped by area. Importing this package registers them all."""

from lakeweave.queries import api, layers, loads, metrics, quality, sources, streams  # noqa: F401
