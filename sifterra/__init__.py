"""sifterra: a PySpark-native engine for building, searching and measuring document corpora."""

__version__ = "0.1.0"
