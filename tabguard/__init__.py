"""Spark-native tabulation of sensitive microdata with bounded contributions and calibrated noise."""
