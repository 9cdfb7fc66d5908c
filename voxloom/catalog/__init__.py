"""Named queries over the corpus tables, one per operator, with the SQL that checks each."""

from voxloom.catalog import chunks, corpus, detection, live, models, signals, texts  # noqa: F401
from voxloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
