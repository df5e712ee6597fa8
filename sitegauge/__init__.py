"""Spark DataFrame operators for comparing companies by what their websites publish."""
