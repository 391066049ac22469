"""Spark-native sketches, ETL, graph, dosage, workflow and batching operators."""

__version__ = "0.1.0"
