"""lectern: quality checks, text metrics and publishing jobs for a catalog of courses, on Spark."""
