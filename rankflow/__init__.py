"""Ranking and tabular-prediction operators expressed as Spark DataFrame plans."""
