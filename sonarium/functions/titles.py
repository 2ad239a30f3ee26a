"""Titles of works: their plain form, the numbers of series, and the titles of owners side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import ascii_fold

# Titles that say nothing of a work, endings that number a title, and how guests are named.
STOP_TITLES = ["intro", "outro", "untitled", "interlude", "skit", "bonus", "bonus track", "demo", "live"]
NUMBERED = r"(?i)(\b(vol|volume|part|pt|episode|ep|no|#)\.?\s*\d+|\s\d{1,3})\s*$"
GUESTS = r"(?i)\((feat|ft|with|prod)[^)]*\)|\b(feat|ft)\.?\s.+$"
#: Letters and digits of any script, marks and ASCII; everything else parts words.
_PARTING = r"[^\x00-\x7F\p{L}\p{N}\p{M}]"


def plain_title(title: Column) -> Column:
    """The words of a title in lower case and ASCII, without guests, one blank between them. Null stays null."""
    letters = ascii_fold(F.regexp_replace(title, _PARTING, " "))
    words = F.split(F.lower(F.regexp_replace(letters, GUESTS, "")), "[^a-z0-9]+")
    return F.array_join(F.filter(words, lambda w: w != ""), " ")


def is_numbered(title: Column) -> Column:
    return title.rlike(NUMBERED)


def title_sets(rows: DataFrame, owner: str, title: str, least: int = 4) -> DataFrame:
    """(owner, plain): the titles that tell an owner's works apart, each once: ``least`` characters or more and no stop
    title. Null owners and titles are left out."""
    plain = rows.where(F.col(owner).isNotNull()).select(owner, plain_title(F.col(title)).alias("plain"))
    return plain.where((F.length("plain") >= least) & ~F.col("plain").isin(STOP_TITLES)).distinct()


def common_titles(a: DataFrame, b: DataFrame, left: str, right: str) -> DataFrame:
    """(left, right, common, smaller): owners of two frames of ``title_sets`` with titles in common, how many these are,
    and how many the one with fewer has. The names of the owners' columns must differ."""
    sizes = {name: side.groupBy(name).agg(F.count("*").alias(f"n_{name}")) for side, name in ((a, left), (b, right))}
    pairs = a.join(b, "plain").groupBy(left, right).agg(F.count("*").alias("common"))
    return pairs.join(sizes[left], left).join(sizes[right], right).select(left, right, "common", F.least(f"n_{left}", f"n_{right}").alias("smaller"))
