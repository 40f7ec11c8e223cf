"""stratum: layered listings/reviews analytics as Spark DataFrame jobs."""
