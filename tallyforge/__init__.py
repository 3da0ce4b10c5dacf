"""Spark-native reconciliation of positioned text and tables into verified, linked financial facts."""
