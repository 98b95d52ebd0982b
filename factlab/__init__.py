"""Spark-native analytics over large event and review style fact tables."""
