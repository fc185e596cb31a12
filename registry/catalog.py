"""All registered queries."""

from registry import cleaning_queries, damage_queries, impact_queries, spatial_queries  # noqa: F401
from registry.base import ORACLES, QUERIES  # noqa: F401
