"""A PySpark-native engine for species-occurrence gap and bias analysis."""

__version__ = "0.1.0"
