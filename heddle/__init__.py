"""heddle: a PySpark-native analytics engine (DataFrame / SQL first)."""
