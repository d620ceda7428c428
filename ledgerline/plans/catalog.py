"""Import every query module so the registry is complete."""

from ledgerline.plans import q_core, q_forecast, q_report, q_sinks  # noqa: F401
from ledgerline.plans.registry import REGISTRY  # noqa: F401 (re-exported)

__all__ = ["REGISTRY"]
