"""Spark-native building blocks for everyday data work on tables and streams."""
