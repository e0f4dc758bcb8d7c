"""Jobs (read, plan, partitioned write) and the registered queries."""
