"""The registered queries: each pairs a Spark query with the SQL it must equal."""
