"""Registered queries and their SQL twins."""

from guideloom.jobs.oracles import ORACLES
from guideloom.jobs.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
