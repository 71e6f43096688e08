"""plyframe: a Spark-native batch engine for analysing sets of chess positions."""
