"""Implausible measurements: robust control charts, run-length counters and physical limits.

Every source has one exponentially weighted chart for each family of its measurements. The chart
works on logarithms: the suspected part of a value is clipped before the value moves the mean and
the scale, so a spike doesn't pull the chart towards itself. A second counter follows runs of equal
values, and physical limits need no chart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strophe.operators.keyed import map_groups


@dataclass(frozen=True)
class ChartRules:
    """ratio: a value this many times, or this part of, the chart's mean is a spike. weight: of a new value in mean and scale.
    clip: values count as at most so many scales away from the mean. run: so many equal values in a row are stuck.
    block, context: a source is charted in blocks of so many positions; each block also sees so many positions before and after it."""

    ratio: float = 3.0
    weight: float = 0.05
    clip: float = 2.5
    least_scale: float = 0.05
    run: int = 5
    block: int = 4096
    context: int = 512


def chart(values: np.ndarray, series: np.ndarray, rules: ChartRules) -> np.ndarray:
    """Logarithms of each value's ratio to the mean of its chart before it. values: logarithms in order of time; series: their chart's number, sorted, from 0."""
    if not len(values):
        return np.zeros(0)
    count = np.bincount(series)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    ranked = values[np.lexsort((values, series))]
    middle = (ranked[first + (count - 1) // 2] + ranked[first + count // 2]) / 2
    away = np.abs(values - middle[series])
    ranked = away[np.lexsort((away, series))]
    spread = (ranked[first + (count - 1) // 2] + ranked[first + count // 2]) / 2
    longest_first = np.argsort(-count, kind="stable")
    mean = middle[longest_first].copy()
    scale = np.maximum(1.4826 * spread[longest_first], rules.least_scale)
    at, left = first[longest_first], count[longest_first]
    off = np.empty_like(values)
    live = len(left)
    for step in range(int(left[0])):
        while left[live - 1] <= step:
            live -= 1
        place = at[:live] + step
        gap = values[place] - mean[:live]
        off[place] = gap
        limit = rules.clip * scale[:live]
        gap = np.clip(gap, -limit, limit)
        mean[:live] += rules.weight * gap
        scale[:live] = np.maximum((1 - rules.weight) * scale[:live] + rules.weight * 1.25 * np.abs(gap), rules.least_scale)
    return off


def run_lengths(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How long the run of equal values is that each value stands in. NaN equals NaN; a run doesn't go on into another group."""
    n = len(values)
    if not n:
        return np.zeros(0, dtype=np.int64)
    same = (values[1:] == values[:-1]) | (np.isnan(values[1:]) & np.isnan(values[:-1]))
    new = np.concatenate(([True], ~(same & (group[1:] == group[:-1]))))
    number = np.cumsum(new) - 1
    return np.bincount(number)[number]


def flag_spikes(df: DataFrame, source: str, position: str, value: str, family: Column, row: str, rules: ChartRules = ChartRules()) -> DataFrame:
    """`row`, `source`, `value`, `ratio`, `reason` of every measurement that can't be believed.

    reason is `limit` (zero, negative, NaN or infinite), `spike` (at least rules.ratio times what is normal, or at most that
    part) or `stuck` (one of rules.run or more equal values in a row), in that order of precedence; ratio is null for `limit`.
    Normal is the mean of the source's chart for the value's family, which starts at the median of the block.
    Rows without a value are skipped and interrupt no run. A null source or family is a source or family of its own; rows with
    a null position come first. Columns other than the named ones are ignored.

    A source may hold a third of all rows: it is charted in blocks by position. Each block also gets the rules.context
    positions before and after it, which settle its chart and show the whole of any run across the border (only a run broken by
    more positions without value than that would count as two).
    """
    place = F.coalesce(F.col(position).cast("long"), F.lit(0))
    block = F.floor(place / rules.block)
    inside = place - block * rules.block
    blocks = F.array_compact(F.array(F.when((inside < rules.context) & (block > 0), block - 1), block, F.when(inside >= rules.block - rules.context, block + 1)))
    rows = (
        df.select(F.col(row).alias("row_id"), F.col(source).alias("source"), place.alias("place"), block.alias("own"), F.col(value).cast("double").alias("value"), F.coalesce(family.cast("int"), F.lit(-1)).alias("family"), blocks.alias("blocks"))
        .filter("value is not null")
        .withColumn("block", F.explode("blocks"))
        .drop("blocks")
    )
    log_ratio = float(np.log(rules.ratio))

    def run(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = table.num_rows
        group = np.zeros(n, dtype=np.int64)
        group[starts[1:]] = 1
        group = np.cumsum(group)
        value = table["value"].to_numpy()
        family = table["family"].to_numpy()
        sound = np.isfinite(value) & (value > 0)
        stuck = run_lengths(value, group) >= rules.run
        kept = np.flatnonzero(sound)
        kept = kept[np.lexsort((family[kept], group[kept]))]
        new = np.ones(len(kept), dtype=np.int64)
        new[1:] = (group[kept][1:] != group[kept][:-1]) | (family[kept][1:] != family[kept][:-1])
        off = np.full(n, np.nan)
        off[kept] = chart(np.log(value[kept]), np.cumsum(new) - 1, rules)
        with np.errstate(invalid="ignore"):
            spike = np.abs(off) >= log_ratio - 1e-9
        own = table["block"].to_numpy() == table["own"].to_numpy()
        out = np.flatnonzero(own & (~sound | spike | stuck))
        if len(out):
            reason = np.where(~sound[out], "limit", np.where(spike[out], "spike", "stuck"))
            picked = table.take(pa.array(out))
            ratio = pa.array(np.exp(off[out]), mask=~sound[out])
            yield from pa.Table.from_arrays([picked["row_id"], picked["source"], picked["value"], ratio, pa.array(reason.tolist(), pa.string())], ["row_id", "source", "value", "ratio", "reason"]).combine_chunks().to_batches()

    kinds = dict(df.dtypes)
    schema = f"row_id {kinds[row]}, source {kinds[source]}, value double, ratio double, reason string"
    found = map_groups(rows, ["source", "block"], ["place", "row_id"], run, schema)
    return found.select(F.col("row_id").alias(row), F.col("source").alias(source), F.col("value").alias(value), "ratio", "reason")
