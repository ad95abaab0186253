"""A PySpark-native engine for linking projects to publications, and for preparing training data."""
