"""Ready queries over the given tables, each with its SQL where SQL can say it."""

from acervo.plans import (  # noqa: F401
    capture, catalogue, clusters, control, digest, documents, enriched, entities, feeds, reports, scalars, streams,
)
from acervo.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
