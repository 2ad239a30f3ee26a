"""Text functions: Unicode forms that Spark lacks, and the name and title normalisers.

Only values with a character outside ASCII travel to Python; for the others the
column handed over is null, so the Arrow batches stay small.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NON_ASCII = r"[^\x00-\x7F]"


@F.pandas_udf(T.StringType())
def _nfc(values: pd.Series) -> pd.Series:
    return values.map(lambda s: unicodedata.normalize("NFC", s), na_action="ignore")


def _ascii(s: str) -> str:
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()


@F.pandas_udf(T.StringType())
def _ascii_fold(values: pd.Series) -> pd.Series:
    return values.map(_ascii, na_action="ignore")


def _only_where_needed(text: Column, udf) -> Column:
    return F.when(text.rlike(NON_ASCII), udf(F.when(text.rlike(NON_ASCII), text))).otherwise(text)


def nfc(text: Column) -> Column:
    """Unicode NFC; null stays null."""
    return _only_where_needed(text, _nfc)


def ascii_fold(text: Column) -> Column:
    """NFKD, then every character outside ASCII dropped; null stays null."""
    return _only_where_needed(text, _ascii_fold)


def same_text(text: Column) -> Column:
    """The form under which two texts count as the same: NFC, runs of blanks and
    tabs as one blank, none at the ends; empty text as null."""
    return F.nullif(F.trim(F.regexp_replace(nfc(text), r"[ \t]+", " ")), F.lit(""))
