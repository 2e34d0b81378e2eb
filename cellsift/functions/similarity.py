"""Text similarity between an invalid category and the allowed ones."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def levenshtein_ratio(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def gestalt_match(allowed: tuple[str, ...], cutoff: float):
    """Arrow UDF: closest allowed value and its matching-blocks ratio, or null.

    Meant for distinct values. The ratio is taken from the value towards the
    match, which is not the direction the search itself uses.
    """
    choices = [str(a) for a in allowed]

    @F.pandas_udf("match string, ratio double")
    def match(values: pd.Series) -> pd.DataFrame:
        found = []
        for value in values:
            near = difflib.get_close_matches(value, choices, n=1, cutoff=cutoff) if value is not None else []
            if near:
                ratio = difflib.SequenceMatcher(None, value, near[0]).ratio()
                found.append((near[0], round(ratio, 4)))
            else:
                found.append((None, None))
        return pd.DataFrame(found, columns=["match", "ratio"])

    return match
