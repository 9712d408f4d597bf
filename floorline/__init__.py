"""Factory telemetry and worker-safety analytics on Spark DataFrames."""

__version__ = "0.1.0"
