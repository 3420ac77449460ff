"""End-to-end flows, the query registry and the SQL each query is checked with."""
