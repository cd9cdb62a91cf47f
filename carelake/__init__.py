"""Healthcare analytics on Spark: clinical bundles to flat tables, reports, features and models."""
