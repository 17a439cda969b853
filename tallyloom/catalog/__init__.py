"""Every operator as a named query over the shared tables, with SQL that gives the same rows."""

from tallyloom.catalog import curation, history, hooks, images, scans, scores, text  # noqa: F401
from tallyloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
