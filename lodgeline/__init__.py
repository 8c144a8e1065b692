"""Booking analytics and model monitoring as Spark DataFrame functions."""
