"""curatrix: a PySpark-native engine for curating and evaluating labelled datasets."""

__version__ = "0.1.0"
