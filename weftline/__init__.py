"""weftline: a Spark-first engine for article extraction, quality control and search."""
