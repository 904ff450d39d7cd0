"""Numbers too large for the built-in types."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def factorial_text(n: pd.Series) -> pd.Series:
    """``n!`` in decimal digits."""
    sys.set_int_max_str_digits(0)
    return n.map(lambda x: str(math.factorial(int(x))))
