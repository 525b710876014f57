"""All registered queries and, where SQL can say it, what they must return."""

from workload import lineage_queries, message_queries, stream_queries
from workload.sql import statement

MODULES = (lineage_queries, message_queries, stream_queries)

QUERIES = {name: run for module in MODULES for name, run in module.QUERIES.items()}
ORACLE = {
    name: statement(body) for module in MODULES for name, body in module.ORACLE.items()
}
