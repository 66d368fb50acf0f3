"""What two renderings of a document have in common, token by token.

Tokens that stand once on both sides are anchors; the longest run of anchors that ascends on both sides, by patience piles,
cuts the texts into gaps, and each gap is searched again for what is unique within it, or in whole once it is small. Equal
beginnings and ends of a gap are kept first. Documents meet in one join and each pair is compared where it is, in about n log n steps a level.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import shared

RUNS = "run int, kind string, left_at int, right_at int, n int, text string"
#: A gap of so many pairs of tokens at most is searched in whole, so that repeated words in it are kept too.
CELLS = 4096
#: Tokens of documents, about, whose runs leave a task together.
BATCH = 200_000
#: Documents that a task compares, about: so many tasks that it is them, not their length, that grow with the input.
DOCUMENTS = 2000
KEPT, LOST, ADDED = "kept", "lost", "added"


def ascending(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of (i, j), given by ascending i, in which j ascends too: patience piles with links back."""
    tops, piles, back = [], [], {}
    for i, j in places:
        at = bisect_left(tops, j)
        if at:
            back[i, j] = piles[at - 1]
        tops[at : at + 1], piles[at : at + 1] = [j], [(i, j)]
    chain = piles[-1:]
    while chain and chain[-1] in back:
        chain.append(back[chain[-1]])
    return chain[::-1]


def exact(a: list[str], b: list[str], i: int, m: int, j: int, n: int) -> list[tuple[int, int]]:
    """A longest common subsequence of a[i:m] and b[j:n], by a table of their lengths: a row is one number, whose bits say where its lengths grow."""
    at: dict[str, int] = {}
    for y in range(j, n):
        at[b[y]] = at.get(b[y], 0) | 1 << n - 1 - y
    every = (1 << n - j) - 1
    same, rows = every, [0]
    for x in range(m - 1, i - 1, -1):
        hit = same & at.get(a[x], 0)
        same = (same + hit | same - hit) & every
        rows.append(every ^ same)
    # the length from (x, y) on is that of the bits of row x below n - y
    kept, x, y, left = [], i, j, rows[-1].bit_count()
    while left:
        if a[x] == b[y]:
            kept.append((x, y))
            x, y, left = x + 1, y + 1, left - 1
        elif (rows[m - x - 1] & (1 << n - y) - 1).bit_count() == left:
            x += 1
        else:
            y += 1
    return kept


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places (i, j) of tokens kept, ascending in both."""
    kept, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        i, m, j, n = gaps.pop()
        while i < m and j < n and a[i] == b[j]:
            kept.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            kept.append((m, n))
        if i == m or j == n:
            continue
        if (m - i) * (n - j) <= CELLS:
            kept += exact(a, b, i, m, j, n)
            continue
        once_a, once_b = Counter(a[i:m]), Counter(b[j:n])
        at = {b[y]: y for y in range(j, n) if once_b[b[y]] == 1}
        chain = ascending([(x, at[a[x]]) for x in range(i, m) if once_a[a[x]] == 1 and a[x] in at])
        kept += chain
        ends = [(i - 1, j - 1), *chain, (m, n)]
        gaps += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(ends, ends[1:], strict=False) if chain]
    return sorted(kept)


def runs(a: list[str], b: list[str]) -> list[tuple[str, int, int, int]]:
    """(kind, place on the left, place on the right, number of tokens) of runs kept, lost and added, in order."""
    out, i, j, n = [], 0, 0, 0  # up to (i, j) all is said but the n tokens kept right before
    for x, y in [*common(a, b), (len(a), len(b))]:
        if x > i or y > j:
            if n:
                out.append((KEPT, i - n, j - n, n))
            if x > i:
                out.append((LOST, i, j, x - i))
            if y > j:
                out.append((ADDED, x, j, y - j))
            n = 0
        i, j, n = x + 1, y + 1, n + 1
    if n > 1:  # the last counts the end
        out.append((KEPT, i - n, j - n, n - 1))
    return out


def tokens(text: str | None) -> list[str]:
    """Tokens between ASCII white space; none in a null or blank text."""
    return re.findall(r"[^ \t\n\x0b\f\r]+", text or "")


def compared(key: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A function of batches of pairs (key, a, b) to their runs, those of many small documents together."""
    names = [key, *(c.split()[0] for c in RUNS.split(", "))]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, size = [], 0
        for rows in batches:
            for k, a, b in zip(rows[key], rows["a"], rows["b"], strict=True):
                a, b = tokens(a), tokens(b)
                found += [(k, r + 1, kind, i, j, n, " ".join(b[j : j + n] if kind == ADDED else a[i : i + n])) for r, (kind, i, j, n) in enumerate(runs(a, b))]
                size += len(a) + len(b)
                if size > BATCH:
                    yield pd.DataFrame(found, columns=names)
                    found, size = [], 0
        if found:
            yield pd.DataFrame(found, columns=names)

    return compare


def diff(left: DataFrame, right: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, run, kind, left_at, right_at, n, text): runs of tokens kept, lost and added of documents that both sides have.

    Runs are numbered from 1, places count tokens from 0. Documents without a token on either side have no run. The kept
    tokens are common to both in order, and lost or added is all else; they are not always as many as could be kept.
    """
    n = shared.tasks(left, DOCUMENTS)
    pairs = left.select(key, F.col(text).alias("a")).repartition(n, key).join(right.select(key, F.col(text).alias("b")).repartition(n, key), key)
    kind = left.schema[key].dataType.simpleString()
    return pairs.mapInPandas(compared(key), f"`{key}` {kind}, {RUNS}")


def report(found: DataFrame, key: str, **more: Column) -> DataFrame:
    """(key, before_length, after_length, similarity, differs) of each document's runs: tokens, and twice the kept over all.

    more: further aggregates of a document's runs, by name, for which they aren't shuffled once more.
    """
    count = lambda *kinds: F.sum(F.when(F.col("kind").isin(*kinds), F.col("n")).otherwise(0))
    before, after = count(KEPT, LOST), count(KEPT, ADDED)
    said = {"before_length": before, "after_length": after, "similarity": 2 * count(KEPT) / (before + after), "differs": count(LOST, ADDED) > 0, **more}
    return found.groupBy(key).agg(*[c.alias(n) for n, c in said.items()])
