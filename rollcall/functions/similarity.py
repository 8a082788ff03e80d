"""Name similarity: Jaro-Winkler, token-set and token-sort ratios. Arrow functions over distinct values."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from rollcall.functions.text import GENERIC_WORDS, MIN_TOKEN


def jaro_winkler(a: str, b: str) -> float:
    """Jaro's measure, raised by a tenth of what is missing for each of up to four equal first letters if it is over 0.7. Two empty strings: 0."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    reach = max(reach, 0)
    used = [False] * len(b)
    matched = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                matched.append(c)
                break
    m = len(matched)
    if not m:
        return 0.0
    others = [c for c, u in zip(b, used) if u]
    moved = sum(x != y for x, y in zip(matched, others)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit for each letter of a (Hyyrö's recurrence)."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        matches = state & where.get(c, 0)
        state = (state + matches | state - matches) & full
    return len(a) - state.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths; 0 if either is empty."""
    return 2.0 * common_subsequence(a, b) / (len(a) + len(b)) if a and b else 0.0


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 1.0
    joined = lambda *parts: " ".join(p for p in parts if p)
    best = ratio(joined(both, left), joined(both, right))
    return max(best, ratio(both, joined(both, left)), ratio(both, joined(both, right))) if both else best


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def core(name: str) -> str:
    return " ".join(t for t in name.split() if t not in GENERIC_WORDS and len(t) >= MIN_TOKEN and not t.isdigit())


def name_similarity(a: str, b: str) -> float:
    """The best of the three measures on canonical names; token-sort looks at the words that tell names apart."""
    return max(jaro_winkler(a, b), token_set(a, b), token_sort(core(a), core(b)))


def _arrow(measure: Callable[[str, str], float]) -> Callable[[Column, Column], Column]:
    @F.pandas_udf(DoubleType())
    def udf(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(a.fillna(""), b.fillna("")):
            value = known.get(pair)
            if value is None:
                value = known[pair] = measure(*pair)
            out.append(value)
        return pd.Series(out, dtype="float64")

    return lambda a, b: udf(a, b)


jaro_winkler_udf = _arrow(jaro_winkler)
token_set_udf = _arrow(token_set)
token_sort_udf = _arrow(token_sort)
name_similarity_udf = _arrow(name_similarity)
