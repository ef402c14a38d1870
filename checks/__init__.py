"""Queries over the driver's tables, each with its SQL where SQL can say it."""

from checks import augment, embeddings, files, inference, ledger, records  # noqa: F401
from checks.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
