"""Importing this module fills the registry."""

from checks import health_checks, load_checks, record_checks, report_checks, stream_checks  # noqa: F401
from checks.registry import QUERIES, SQL  # noqa: F401
