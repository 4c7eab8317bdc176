"""Named queries: each has a Spark plan and, where SQL can say it, an equivalent SQL text."""
