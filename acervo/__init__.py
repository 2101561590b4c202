"""acervo: document capture, enrichment and reporting as Spark jobs."""
