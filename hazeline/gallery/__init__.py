"""The pipeline's operators as queries over the test tables, each with its SQL equivalent."""

from hazeline.gallery import basics, incremental, planning, storage, streams, upkeep  # noqa: F401
from hazeline.gallery.registered import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
