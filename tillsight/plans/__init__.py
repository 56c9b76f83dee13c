"""Analytics marts over the star (customer, retention, sales, products, geography, executive),
plus the ETL steps exposed as queries. ``registry()`` maps each query key to a callable
``(star) -> DataFrame``; ``oracle()`` maps keys to DuckDB SQL."""

from __future__ import annotations

import importlib

_MODULES = ["customer", "retention", "sales", "executive", "geography", "products"]


def _mods():
    return [importlib.import_module(f"tillsight.plans.{m}") for m in _MODULES]


def registry() -> dict:
    out = {}
    for m in _mods():
        out.update(m.MARTS)
    return out


def etl_queries() -> dict:
    """ETL steps and checks, as ``(spark, sf_dir) -> DataFrame``."""
    from tillsight.plans import etl
    return dict(etl.QUERIES)


def oracle() -> dict:
    from tillsight.plans import etl
    out = {}
    for m in _mods() + [etl]:
        out.update(m.ORACLE)
    return out
