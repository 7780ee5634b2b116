"""PySpark-native analytics over timestamped market evidence."""
