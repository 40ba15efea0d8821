"""Document-structure analytics on Spark: parsing, record assembly, reference graphs and corpus hygiene."""
