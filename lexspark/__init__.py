"""lexspark: a PySpark-native engine for lexical and document data."""
