"""Data tests that belong to the models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.operators import quality


def model_checks(teacher_table: str = "base_docentes") -> dict[str, list]:
    """Model -> (test, column) pairs."""
    silver = f"silver_{teacher_table}"
    return {silver: [("not_null", f"{silver}_disciplina"), ("unique", f"{silver}_id")]}


def run_checks(built: dict[str, DataFrame], teacher_table: str = "base_docentes") -> DataFrame | None:
    """Results of the tests of all built models, one row each; None where no model has a test. One scan per model."""
    results = [
        quality.run_all(built[model], tests).select(F.lit(model).alias("model"), "*")
        for model, tests in model_checks(teacher_table).items()
        if model in built
    ]
    return reduce(DataFrame.unionByName, results) if results else None
