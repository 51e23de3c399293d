"""Spark-native concept-identifier (CURIE) normalization.

Ingest turns releases of synonym cliques (JSON lines) and conflation clusters
(one list literal per line) into nine relational tables; lookups answer
normalization questions as set-based joins over those tables.
"""

from conceptnorm.plans.vocabulary import Vocabulary
from conceptnorm.session import configure, get_spark

__all__ = ["Vocabulary", "configure", "get_spark"]
