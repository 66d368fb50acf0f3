"""A PySpark-native engine for scholarly document collections."""
