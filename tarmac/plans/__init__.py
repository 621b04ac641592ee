"""Layer jobs: bronze (CSV → typed tables), silver (wide table), gold (marts),
and the dashboard's data over the gold tables."""

from tarmac.plans.bronze import build_bronze
from tarmac.plans.gold import build_gold
from tarmac.plans.silver import OBT_TABLE, build_silver

__all__ = ["OBT_TABLE", "build_bronze", "build_gold", "build_silver"]
