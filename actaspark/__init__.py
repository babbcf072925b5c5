"""actaspark: a PySpark-native engine for official-record publications and registry data."""
