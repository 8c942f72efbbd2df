"""Column-name normalisation."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def snake_case(name: str) -> str:
    return "_".join(re.findall(r"[0-9a-zA-Z]+", name)).lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(snake_case, df.columns))
