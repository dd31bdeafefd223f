"""Land-surface series, samples and maps as Spark DataFrame operators."""
