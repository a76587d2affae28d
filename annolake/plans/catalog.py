"""Every registered query with the SQL it must agree with."""

from __future__ import annotations

from annolake.plans import curation, formats, labelsets, matching, review, similarity, tracking
from annolake.plans.query import Query

QUERIES: dict[str, Query] = {**matching.QUERIES, **tracking.QUERIES, **similarity.QUERIES, **curation.QUERIES, **review.QUERIES, **labelsets.QUERIES, **formats.QUERIES}
