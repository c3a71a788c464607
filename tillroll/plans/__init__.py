"""All named queries."""

from tillroll.plans import mining, models, orders, retail  # noqa: F401
from tillroll.plans.registry import PLANS

__all__ = ["PLANS"]
