"""Candle analytics expressed as Spark DataFrame, streaming and ML jobs."""
