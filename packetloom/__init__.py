"""Spark-native analytics for labelled and live network-event records."""
