"""Queries over the test tables."""

from . import agreement, columns, maintenance, money, recon, stock, supply, tracking, windows  # noqa: F401
from .registry import QUERIES  # noqa: F401
