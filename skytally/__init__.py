"""Skytally: flight-operations analytics expressed as Spark DataFrame plans."""
