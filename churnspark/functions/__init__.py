"""churnspark.functions."""
