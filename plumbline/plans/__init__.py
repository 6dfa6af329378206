"""Registered queries over the given tables and the SQL that checks them."""

from __future__ import annotations

from plumbline.plans.registry import ORACLES, QUERIES, Query


def _load() -> None:
    from plumbline.plans import (  # noqa: F401
        compare_queries,
        discovery_queries,
        leave_queries,
        lineage_queries,
        profile_queries,
        quality_queries,
    )


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
