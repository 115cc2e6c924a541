"""Fare and price analytics as parameterised PySpark DataFrame operators."""
