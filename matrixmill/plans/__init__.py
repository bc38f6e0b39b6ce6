"""Join strategy, table layout, batch jobs and the registered queries."""
