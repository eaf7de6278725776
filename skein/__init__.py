"""skein: a PySpark-native engine for claim graphs, rankings and corpus work."""
