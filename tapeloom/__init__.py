"""Trading-desk execution analytics as Spark DataFrame functions."""
