"""Air-quality speciation analytics as Spark DataFrame jobs."""
