"""annolake: a PySpark-native analytics engine for visual-annotation data."""
