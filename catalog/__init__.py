"""The registered queries: views over the shared tables, Spark queries, SQL twins."""
