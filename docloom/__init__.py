"""docloom: incrementally maintained document tables on Spark.

A document table is the result of one Spark SQL query with typed column aliases.  Row-level changes of the
base tables are routed to documents, folded to their net effect and applied to a partitioned Parquet table.
"""

from docloom.operators.rules import IngestRule, TableFeed
from docloom.operators.source import DocSource
from docloom.plans.target import DocTable

__all__ = ["DocSource", "DocTable", "IngestRule", "TableFeed"]
