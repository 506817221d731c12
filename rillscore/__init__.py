"""Spark-native batch scoring: sources, batch plans, scorers, projections, sinks and run journals as DataFrame stages."""

__version__ = "0.2.0"
