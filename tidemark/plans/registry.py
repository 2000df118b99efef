"""The reference-side queries and the SQL that checks them."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}
