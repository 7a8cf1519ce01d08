"""tickloom: market-data engineering and analysis as Spark DataFrame jobs."""
