"""Every runnable query of the library, by topic."""

from . import audits, catalogue, costing, fifo, flows, kpis, prices, repairs, sales, stock  # noqa: F401
from .registry import CHECKS, QUERIES  # noqa: F401
