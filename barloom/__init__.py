"""Market-bar analytics expressed as Spark DataFrame operators."""
