"""Step-function time series of agreed increases, built as Spark jobs."""
