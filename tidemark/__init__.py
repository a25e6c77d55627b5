"""Spark-native preparation and analysis of multimodal, time-aligned training corpora."""
