"""dirspark: a PySpark-native engine for directory data (places, phones, registers) and its queries."""
