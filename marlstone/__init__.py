"""A PySpark-native engine that consolidates event data from many feeds."""
