"""Event analytics on Spark: composable DataFrame operators for mixed JSON event streams."""

__version__ = "0.1.0"
