"""Spark-native corpus preparation: sources, text functions, operators, plans and streaming."""
