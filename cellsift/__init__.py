"""Data-quality jobs on Spark DataFrames.

Declare rules for the columns of a table, then let Spark find missing, invalid
and anomalous cells, suggest a repair for each, apply repairs and report.
"""

import sys

from pyspark import cloudpickle

from cellsift.spec import (
    ColumnRule,
    CrossFieldRule,
    QualitySpec,
    SpecError,
    bank_spec,
    load_spec,
)

__all__ = [
    "ColumnRule",
    "CrossFieldRule",
    "QualitySpec",
    "SpecError",
    "bank_spec",
    "load_spec",
]

# Functions used in tasks travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
