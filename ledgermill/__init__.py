"""Subscription-finance warehouse built from Spark DataFrame operators."""
