"""Rating streams: clean rows, current stages, current ratings."""
