"""All registered queries."""

from importlib import import_module

from tillroll.catalogue.registry import REGISTRY

AREAS = (
    "predicates", "joins", "aggregates", "reports_sales", "reports_stock", "reports_money", "reports_cashiers", "loads_exports",
    "streams",
)

for _area in AREAS:
    import_module(f"tillroll.catalogue.{_area}")

__all__ = ["REGISTRY"]
