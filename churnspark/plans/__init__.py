"""churnspark.plans."""
