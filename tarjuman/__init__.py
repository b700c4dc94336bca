"""Spark-native translation of the text columns of large tables and streams."""

from tarjuman.plans.job import run_job
from tarjuman.plans.translate import translate_table

__all__ = ["run_job", "translate_table"]
