"""churnspark.streaming."""
