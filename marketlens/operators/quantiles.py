"""Exact quantiles of integer measures, by histogram refinement.

The built-in exact ``percentile`` keeps every distinct value of a column in one
task.  Here each pass counts values by their next twelve bits, only inside the
buckets that hold a wanted rank, so a pass returns at most 4096 rows per wanted
rank whatever the size or skew of the data, and the answer is still exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

DIGIT_BITS = 12


@dataclass
class _Search:
    """A wanted rank: the bucket found so far and the rank inside it."""

    measure: str
    rank: int
    within: int
    bucket: int = 0


def order_statistics(values: DataFrame, ranks: dict[str, Sequence[int]], spans: dict[str, tuple[int, int]]) -> dict[str, dict[int, int]]:
    """Values at zero-based ranks; ``values`` holds one integer column per measure."""
    searches = [_Search(m, r, r) for m, wanted in ranks.items() for r in sorted(set(wanted))]
    shift = max((high - low).bit_length() for low, high in spans.values())
    cells = values.select(*[(F.col(m) - low).alias(m) for m, (low, _) in spans.items()])
    cells = cells.unpivot([], list(spans), "measure", "cell").filter(F.col("cell").isNotNull())
    while shift > 0:
        step = max(shift - DIGIT_BITS, 0)
        counts = (
            cells.filter(_in_open_buckets(searches, shift))
            .groupBy("measure", F.shiftright("cell", step).alias("bucket"))
            .count()
            .collect()  # at most 4096 rows per wanted rank
        )
        found: dict[str, list[tuple[int, int]]] = {}
        for row in sorted(counts, key=lambda r: r.bucket):
            found.setdefault(row.measure, []).append((row.bucket, row["count"]))
        for search in searches:
            _descend(search, found[search.measure], shift - step)
        shift = step
    result: dict[str, dict[int, int]] = {m: {} for m in ranks}
    for search in searches:
        result[search.measure][search.rank] = search.bucket + spans[search.measure][0]
    return result


def _in_open_buckets(searches: list[_Search], shift: int) -> Column:
    open_buckets: dict[str, set[int]] = {}
    for search in searches:
        open_buckets.setdefault(search.measure, set()).add(search.bucket)
    tests = [
        (F.col("measure") == measure) & F.shiftright("cell", shift).isin(*buckets)
        for measure, buckets in open_buckets.items()
    ]
    return reduce(Column.__or__, tests)


def _descend(search: _Search, histogram: list[tuple[int, int]], bits: int) -> None:
    for bucket, count in histogram:
        if bucket >> bits != search.bucket:
            continue
        if search.within < count:
            search.bucket = bucket
            return
        search.within -= count
    raise AssertionError(f"rank {search.rank} of {search.measure} lies outside the data")


def quantile_edges(values: DataFrame, measures: dict[str, float], bins: int) -> dict[str, list[float]]:
    """Linearly interpolated edges of ``bins`` equal-count bins, smallest value to largest.

    ``measures`` maps each integer column to the unit it is counted in: cents are
    stored as integers with unit 100.  Edges that coincide raise, since the bins
    would be ambiguous.
    """
    summary = values.agg(
        *[f(m).alias(f"{name}|{m}") for m in measures for name, f in
          (("n", F.count), ("low", F.min), ("high", F.max))]
    ).first()
    if any(summary[f"n|{m}"] == 0 for m in measures):
        raise ValueError("quantile edges of an empty column")
    spans = {m: (summary[f"low|{m}"], summary[f"high|{m}"]) for m in measures}
    positions = {m: [(summary[f"n|{m}"] - 1) * i / bins for i in range(bins + 1)] for m in measures}
    ranks = {m: [r for p in at for r in (math.floor(p), math.ceil(p))] for m, at in positions.items()}
    exact = order_statistics(values.select(*measures), ranks, spans)
    edges = {m: [_between(exact[m], p, measures[m]) for p in at] for m, at in positions.items()}
    for measure, cuts in edges.items():
        if len(set(cuts)) != len(cuts):
            raise ValueError(f"bin edges of {measure} must be unique: {cuts}")
    return edges


def _between(exact: dict[int, int], position: float, unit: float) -> float:
    low, high = exact[math.floor(position)] / unit, exact[math.ceil(position)] / unit
    return low + (high - low) * (position - math.floor(position))


def bin_label(value: Column, edges: Sequence[float], labels: Sequence[int]) -> Column:
    """Label of the right-closed bin a value falls in; the lowest edge is included."""
    ladder = F.when(value <= edges[1], labels[0])
    for edge, label in zip(edges[2:], labels[1:]):
        ladder = ladder.when(value <= edge, label)
    return ladder
