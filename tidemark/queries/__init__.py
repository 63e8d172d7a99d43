"""All registered queries."""

from tidemark.queries import classify, events, lake, messages, retail, stocks  # noqa: F401
from tidemark.queries.registry import ORACLES, RUNS  # noqa: F401
