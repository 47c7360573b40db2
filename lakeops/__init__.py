"""Layered (raw -> cleaned -> curated) analytics built from PySpark DataFrame operators."""

__version__ = "0.1.0"
