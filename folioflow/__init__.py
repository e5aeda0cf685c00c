"""A Spark-native engine for turning articles into clean, queryable records."""
