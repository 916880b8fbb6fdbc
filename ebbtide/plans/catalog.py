"""Every registered query; importing the query modules fills the registry."""

from . import queries_evaluation, queries_features, queries_learning, queries_profile, queries_tables  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
