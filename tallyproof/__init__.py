"""tallyproof: a Spark-native engine for proving batch data before it is published."""
