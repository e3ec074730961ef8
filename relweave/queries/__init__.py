"""All registered queries."""

from . import aggregations, annotations, evaluation, exported, expressions, features, graphs, inner, joins, learning, planted, preparation, relevance, reshape, stores  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
