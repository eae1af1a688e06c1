"""Customer purchase-history analytics as Spark jobs."""
