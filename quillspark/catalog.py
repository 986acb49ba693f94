"""All queries of the engine by name, and the SQL that each must agree with."""

from __future__ import annotations

from quillspark import plans
from quillspark.plans import answers, checks, chinese, chunks, corpus, index, pages, round_trips, semantics  # noqa: F401  (they register their queries)


def queries() -> dict[str, plans.Query]:
    return dict(plans.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(plans.SQL)
