"""All registered queries."""

from offerscope.plans import (  # noqa: F401
    annotation_queries,
    label_queries,
    text_queries,
    vector_queries,
)
from offerscope.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
