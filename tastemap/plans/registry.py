"""All registered queries (importing the modules fills the two tables)."""

from . import queries, queries_eval, queries_factor, queries_io, queries_knn  # noqa: F401
from .queries import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
