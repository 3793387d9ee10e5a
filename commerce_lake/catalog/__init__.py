"""Every operator, model, check and analysis as a query with a SQL oracle."""

from __future__ import annotations

from commerce_lake.catalog import analysis, checks, columns, models, relational, storage

_PARTS = (models, analysis, checks, columns, relational, storage)


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for part in _PARTS:
        merged.update(getattr(part, attribute))
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict[str, str]:
    return _merged("ORACLES")
