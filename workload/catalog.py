"""All registered queries: name -> (query, SQL or None)."""

from __future__ import annotations

from workload import eval_queries, mining_queries, policy_queries, text_queries

ENTRIES = {}
for module in (text_queries, mining_queries, policy_queries, eval_queries):
    ENTRIES.update(module.QUERIES)
