"""City mobility, air-quality and economy tables as Spark jobs."""
