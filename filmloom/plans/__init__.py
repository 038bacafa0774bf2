"""End-to-end jobs: catalog cleaning, recommendation, lifecycle routing, comparison."""
