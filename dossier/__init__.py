"""Document evidence analytics expressed as Spark jobs."""
