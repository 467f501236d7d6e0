"""Place-data analytics on Spark: code hierarchies, keyword search, keyed upserts, task states and exports."""
