"""postmill: Q&A-archive ingestion, cleaning, enrichment and reporting on Spark."""
