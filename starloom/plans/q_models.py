"""The twenty star-schema models as registered queries (full refresh)."""

from __future__ import annotations

from .layers import MODELS, Warehouse
from .oracle_models import model_sql
from .registry import query


def _register(name: str) -> None:
    def build(spark, d, _name=name):
        return getattr(Warehouse(spark, d), _name)
    build.__name__ = f"q_{name}"
    query(name, model_sql(name))(build)


for _m in MODELS:
    _register(_m)
