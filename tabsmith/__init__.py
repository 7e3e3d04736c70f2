"""tabsmith: DataFrame operators and batch jobs for transaction cleaning,
multi-source sales loading and price-bar analysis, on Spark."""

__version__ = "0.1.0"
