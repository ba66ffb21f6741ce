"""Registered queries over the test tables."""

from wattline.plans import basic, modelled  # noqa: F401  (importing registers the queries)
from wattline.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
