"""Tidemark: shop-clickstream analytics as pure DataFrame -> DataFrame functions on Spark."""
