"""A Spark-native analytics engine for pitch, segment and transcript-quality data."""
