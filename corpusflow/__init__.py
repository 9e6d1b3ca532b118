"""corpusflow: a PySpark-native engine for page-structured document corpora."""
