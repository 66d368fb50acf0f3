"""Queries of the library by name, and the SQL that each is compared with."""

from __future__ import annotations

from .plans import groupings, inference, issues, links, markup, packaging, registry, reporting, stores, streams, texts, trees

PLANS = (texts, issues, links, groupings, packaging, reporting, markup, trees, stores, inference, streams)
FLAGSHIP: registry.Query = texts.similarity_report


def queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
