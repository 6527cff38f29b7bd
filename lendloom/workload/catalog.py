"""All registered queries: importing the modules fills the registry."""

from lendloom.workload import (  # noqa: F401
    encoding, evaluation, extraction, history, learning, ledger, nested, profiling, scalars, transfer, vendors,
)
from lendloom.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
