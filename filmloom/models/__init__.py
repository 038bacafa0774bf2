"""Model fitting as sequences of Spark jobs."""
