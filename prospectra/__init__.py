"""A PySpark-native engine for directory-style prospect data."""
