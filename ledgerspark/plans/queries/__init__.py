"""The registered queries, one module per area; importing registers them."""

from . import gates, marts, ml, modeling, silver, star, storage, streams  # noqa: F401
from .registry import ORACLES, QUERIES, SPEC  # noqa: F401
