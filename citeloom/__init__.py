"""Spark-native bibliographic graph and corpus analytics."""
