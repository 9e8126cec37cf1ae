"""Session analytics marts on Spark."""
