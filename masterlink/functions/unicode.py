"""Functions that the JVM lacks, as Arrow-batched pandas UDFs."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType


@F.pandas_udf(StringType())
def nfkc_casefold(texts: pd.Series) -> pd.Series:
    """NFKC and case folding; null stays null."""
    return texts.map(lambda t: unicodedata.normalize("NFKC", t).casefold(), na_action="ignore")


@F.pandas_udf(StringType())
def unicode_norm(texts: pd.Series) -> pd.Series:
    """Lower case, compatibility-decomposed, without marks; runs of other than letters and digits are one space."""

    def norm(text: str) -> str:
        plain = (c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
        return " ".join("".join(c if c.isalnum() else " " for c in plain).split())

    return texts.map(norm, na_action="ignore")


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, with a row of bits per character of b."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(DoubleType())
def lcs_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the longest common subsequence over the sum of lengths; 1 for two empty texts, null if one is null."""

    def ratio(x: str | None, y: str | None) -> float | None:
        if x is None or y is None:
            return None
        return 2 * lcs_length(x, y) / (len(x) + len(y)) if x or y else 1.0

    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(ArrayType(StringType()))
def segment(texts: pd.Series) -> pd.Series:
    """Words as Unicode text segmentation gives them: ideographs and kana one by one, other letters and digits in runs."""

    def single(c: str) -> bool:
        return "぀" <= c <= "ヿ" and not "゠" <= c <= "ヿ" or "㐀" <= c <= "鿿" or "豈" <= c <= "﫿" or "\U00020000" <= c <= "\U0003134f"

    def cut(text: str) -> list[str]:
        out: list[str] = []
        run = ""
        for k, c in enumerate(text):
            joins = c in "'’." and run and k + 1 < len(text) and (text[k + 1].isalpha() and run[-1].isalpha() if c != "." else text[k + 1].isdigit() and run[-1].isdigit())
            if single(c) or not (c.isalnum() or c == "_" or unicodedata.combining(c) or joins):
                out += [run] if run else []
                out += [c] if single(c) else []
                run = ""
            else:
                run += c
        return out + ([run] if run else [])

    return texts.map(cut, na_action="ignore")
