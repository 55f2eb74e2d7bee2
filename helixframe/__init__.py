"""Spark-native analytics for repeat-family libraries: typed sources, interval, sequence and set operators."""
