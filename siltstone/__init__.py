"""siltstone: a PySpark-native engine for language-model data work."""
