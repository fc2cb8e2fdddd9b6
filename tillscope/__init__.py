"""Purchase analytics on Spark: address functions, address-to-country join, ranking
reports, file and database sinks, and date-routed streaming ingest."""
