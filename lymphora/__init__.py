"""A PySpark-native engine for repertoire sequencing analytics."""
