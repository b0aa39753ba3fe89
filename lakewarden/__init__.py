"""lakewarden: governed-lakehouse analytics as plain Spark DataFrame jobs."""
