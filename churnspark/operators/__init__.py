"""churnspark.operators."""
