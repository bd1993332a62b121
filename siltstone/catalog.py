"""All registered queries of the library; importing this module fills the registry."""

from __future__ import annotations

from .plans import agents, dedup, formats, mixing, serving, stats, text
from .registry import ORACLES, QUERIES

FLAGSHIP = dedup.line_dedup
__all__ = ["FLAGSHIP", "ORACLES", "QUERIES", "agents", "dedup", "formats", "mixing", "serving", "stats", "text"]
