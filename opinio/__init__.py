"""Review analytics and review retrieval as plain Spark jobs."""
