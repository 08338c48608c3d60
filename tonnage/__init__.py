"""A PySpark-native engine for longitudinal strength-competition records."""
