"""gridloom: a PySpark-native analytics engine for five-minute power-system series."""
