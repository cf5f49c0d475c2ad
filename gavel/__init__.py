"""Spark-native analytics over catalogues of public documents."""
