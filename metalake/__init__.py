"""metalake: a PySpark-native engine for catalogued data lakes."""

__version__ = "0.1.0"
