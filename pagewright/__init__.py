"""pagewright: a PySpark-native engine for document-structure analytics."""
