"""Newsloom: Spark-native analytics for streams of multilingual documents."""
