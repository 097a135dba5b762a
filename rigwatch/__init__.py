"""Condition monitoring of multi-rate rig sensors on Spark."""
