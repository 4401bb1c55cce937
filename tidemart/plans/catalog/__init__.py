"""All registered queries; importing this package fills the registry."""

from tidemart.plans.catalog import (  # noqa: F401
    dashboard, gold, monitoring, parsing, profiling, serving, silver, sources, streams, text,
)
from tidemart.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
