"""workgrid: workforce capacity and performance analytics on Spark."""

from .config import Params, fixture_params
from .plans.model import GoldModel

__all__ = ["GoldModel", "Params", "fixture_params"]
