"""A PySpark-native engine: documents to structured records, code and verdicts, and training-data operations."""
