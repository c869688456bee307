"""tidemart: a layered retail warehouse expressed as Spark DataFrame jobs."""
