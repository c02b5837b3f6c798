"""churnspark: customer-churn analytics as Spark DataFrame, ML and Structured
Streaming jobs (cleaning, profiling, features, splits, models, scoring,
money-based evaluation and monitoring) for tables of any size."""

__version__ = "0.1.0"
