"""loadcast: hourly regional load forecasting on PySpark DataFrames and streams."""

__version__ = "0.1.0"
