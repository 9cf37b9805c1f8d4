"""All registered queries."""

from . import joins_catalog, ledger_catalog, metrics_catalog, rows_catalog, screen_catalog, stream_catalog  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
