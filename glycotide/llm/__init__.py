"""Training-data operators: packing, tokenizing, filtering, search and deduplication as Spark jobs."""
