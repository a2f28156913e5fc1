"""Every query of the library outside its ``llm`` subpackage, with DuckDB SQL that gives the same rows."""

from tidewright.plans import record_queries, table_queries  # noqa: F401  they register their queries
from tidewright.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
