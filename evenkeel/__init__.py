"""evenkeel: web pages and target texts to a balanced fine-tuning set, on Spark."""

__version__ = "0.1.0"
