"""Spark-native preparation, checking, modelling and monitoring of large customer tables."""
