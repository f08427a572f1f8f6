"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: Latin letters with marks and their plain letters
_MARKED = "áàâãäéèêëíìîïóòôõöúùûüçñ"
_PLAIN = "aaaaaeeeeiiiiooooouuuucn"


def fold_accents(s: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(s), _MARKED, _PLAIN)


def contains_any(s: Column, words: list[str]) -> Column:
    test = F.lit(False)
    for word in words:
        test = test | F.contains(s, F.lit(word))
    return test
