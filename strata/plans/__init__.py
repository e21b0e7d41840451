"""Layer jobs composed from operators: bronze, silver, gold, gate, pipeline."""
