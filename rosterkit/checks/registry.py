"""All check queries, registered by importing their modules."""

from . import catalog, q_files, q_io, q_ops, q_reports  # noqa: F401
from .catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
