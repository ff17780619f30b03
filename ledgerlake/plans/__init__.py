"""Model graph, dashboard queries, the pipeline run and the query registry."""
