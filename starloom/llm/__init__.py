"""Training-data operators: text quality, formatting, tokens, language, secrets,
near-duplicates, packing, toxicity and exact vector search as Spark jobs."""
