"""Spark-native zonal and temporal measurement analytics."""
