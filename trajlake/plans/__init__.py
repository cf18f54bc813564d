from . import catalog_queries, io_queries, message_queries, pipeline_queries  # noqa: F401  (they register their queries)
