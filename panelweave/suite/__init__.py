"""The registered queries and their SQL counterparts."""

from panelweave.suite import comparisons, counts, scans, vocabularies, written_files  # noqa: F401
from panelweave.suite.registry import ORACLE, QUERIES, SCAN_ORACLE, SCAN_QUERIES  # noqa: F401
