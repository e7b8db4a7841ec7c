"""Header normalisation and header-drift renames.

These act on column *names* (schema metadata held by the driver), never
on rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_name(name: str) -> str:
    """One header -> snake_case: ASCII-fold, ``%`` -> ``percent``, ``#`` ->
    ``number``, split camelCase, lower-case, every run of other characters
    -> ``_``, no leading/trailing ``_``, a leading digit gets ``x``."""
    s = unicodedata.normalize("NFKD", str(name)).encode("ascii", "ignore").decode("ascii")
    s = s.replace("'", "").replace('"', "")
    s = s.replace("%", " percent ").replace("#", " number ")
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"[^A-Za-z0-9]+", "_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s


def clean_names(names: Iterable[str]) -> list[str]:
    """Clean every header; a name already given gets ``_2``, ``_3``... until
    it is unique, whatever the other headers are."""
    out: list[str] = []
    taken: set[str] = set()
    for n in names:
        base = name = clean_name(n)
        k = 1
        while name in taken:
            k += 1
            name = f"{base}_{k}"
        taken.add(name)
        out.append(name)
    return out


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename every column of ``df`` to its cleaned name."""
    return df.toDF(*clean_names(df.columns))


def rename_drift(df: DataFrame, drift: Iterable[tuple[str, str]]) -> DataFrame:
    """Rename old header names to current ones; absent names are ignored.
    Where a scan merged old and new files, so that both names are there, the
    two columns become one (a row has a value under one of them)."""
    for old, new in drift:
        if old in df.columns and new in df.columns:
            df = df.withColumn(new, F.coalesce(F.col(new), F.col(old))).drop(old)
        elif old in df.columns:
            df = df.withColumnRenamed(old, new)
    return df
