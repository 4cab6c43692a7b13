"""Tributary: many content sources flowing into one normalized corpus, on Spark."""
