"""All queries of the subpackage, and the SQL of those that SQL can express."""
from lectern.llm import corpus_queries, page_queries, structure_queries, text_queries

_PARTS = (page_queries, corpus_queries, text_queries, structure_queries)
Q = {name: fn for part in _PARTS for name, fn in part.Q.items()}
SQL = {name: sql for part in _PARTS for name, sql in part.SQL.items()}
