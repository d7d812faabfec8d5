"""A Spark-native engine for daily, multi-source gridded observations."""
