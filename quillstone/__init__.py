"""PySpark-native analytics engine for company-register style data."""
