"""Registry analytics on Spark: cleaning, linkage, classification, cubes and questions."""
