"""A PySpark-native engine for building, auditing and correcting multilingual evaluation datasets."""
