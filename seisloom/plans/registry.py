"""Queries by name, with the SQL that gives the same rows."""

from __future__ import annotations

from . import catalog, jobs, more, rules, stored, streams

QUERIES: dict = {**catalog.QUERIES, **jobs.QUERIES, **more.QUERIES, **stored.QUERIES, **rules.QUERIES, **streams.QUERIES}
ORACLES: dict[str, str] = {**catalog.ORACLES, **jobs.ORACLES, **more.ORACLES, **stored.ORACLES, **rules.ORACLES, **streams.ORACLES}
