"""churnspark.sources."""
