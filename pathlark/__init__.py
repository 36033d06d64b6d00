"""Behaviour-stream analytics and recommendation as Spark DataFrame functions."""
