"""vanquarry: a PySpark-native engine for legal-text benchmarks and corpus preparation."""
