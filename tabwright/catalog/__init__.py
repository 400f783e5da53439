"""The queries over the driver's tables, each with its SQL where SQL can say it."""

from tabwright.catalog import clean, evaluate, fit, model, profile, split  # noqa: F401
from tabwright.catalog.registry import REGISTRY

__all__ = ["REGISTRY"]
