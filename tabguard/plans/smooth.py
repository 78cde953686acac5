"""Noisy tables to valid estimates: non-negative counts and bounded ratios with 90% intervals.

Every group below is one region x iteration of one table and holds at most its cells, a few dozen rows,
so the Arrow functions never need more than that; the samplers draw many groups side by side.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabguard.functions.gaussian import hazard, sum_quantiles, truncated_points, truncated_quantile
from tabguard.operators.joins import join_num_denom_broadcast_cell, join_num_denom_by_cell
from tabguard.operators.noise import margin_of_error
from tabguard.operators.ranks import exact_percentile

# Leaf cells behind every subtotal and total cell of the count tables.
MARGINS = {
    "PH2": {2: [3, 4], 5: [6, 7], 8: [9, 10], 11: [12, 13], 1: [3, 4, 6, 7, 9, 10, 12, 13]},
    "PH3": {3: [4, 5, 6, 7], 8: [9, 10], 1: [2, 4, 5, 6, 7, 9, 10]},
    "PH4": {1: [2, 3]},
    "PH6": {
        2: [3, 4, 5, 6],
        7: [8, 9, 10, 11],
        12: [13, 14, 15, 16],
        17: [18, 19, 20, 21],
        1: [3, 4, 5, 6, 8, 9, 10, 11, 13, 14, 15, 16, 18, 19, 20, 21],
    },
    "PH7": {1: [2, 3, 4]},
}
ALPHA = 0.05
TRUN = 10.0
# Draws of the ratio models, and how many deviations above its noisy value a bounded quantity may lie.
DRAWS = 10_000
DEVIATIONS = 6.0
CHAINS = 200
BLOCK = 64
"""Groups that are drawn side by side."""
BURN_IN = 50
SEED = 777
EXCLUDED_LEVELS = ("TRACT", "PLACE", "BLOCK_GROUP", "AIANNH")


def region_types_present(df: DataFrame, excluded: Sequence[str] = EXCLUDED_LEVELS) -> DataFrame:
    """Region levels of a table minus the excluded ones."""
    return df.select("REGION_TYPE").distinct().filter(~F.col("REGION_TYPE").isin(list(excluded)))


def pad_region_id(region: Column, width: int = 2) -> Column:
    """Region id padded with zeros on the left; longer ids stay whole."""
    text = region.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def marginal_cells(leaves: DataFrame, margins: Mapping[int, Sequence[int]]) -> DataFrame:
    """Leaf rows plus their subtotal and total rows: counts and variances are sums, margins follow.

    ``leaves`` holds REGION_ID, REGION_TYPE, ITERATION_CODE, DATA_CELL, COUNT, VARIANCE.
    """
    parents = F.array().cast("array<int>")
    for target, sources in margins.items():
        hit = F.when(F.col("DATA_CELL").isin(list(sources)), F.array(F.lit(target)))
        parents = F.concat(parents, F.coalesce(hit, F.array().cast("array<int>")))
    keys = ["REGION_ID", "REGION_TYPE", "ITERATION_CODE"]
    sums = (
        leaves.withColumn("__cell", F.explode(parents))
        .groupBy(*keys, "__cell")
        .agg(F.sum("COUNT").alias("COUNT"), F.sum("VARIANCE").alias("VARIANCE"))
        .withColumnRenamed("__cell", "DATA_CELL")
    )
    both = leaves.select(*sums.columns).unionByName(sums)
    return both.select(
        pad_region_id(F.col("REGION_ID")).alias("GEOID"),
        "REGION_TYPE",
        "ITERATION_CODE",
        "DATA_CELL",
        F.col("COUNT").alias("COUNT_NOISY"),
        "VARIANCE",
        margin_of_error(F.col("VARIANCE")).alias("MOE_NOISY"),
    )


def with_total_cell(part: DataFrame) -> DataFrame:
    """Rows plus a total cell 1 per region and iteration that sums counts and variances."""
    keys = ["REGION_ID", "REGION_TYPE", "ITERATION_CODE"]
    total = part.groupBy(*keys).agg(F.sum("COUNT").alias("COUNT"), F.sum("VARIANCE").alias("VARIANCE"))
    columns = [*keys, "DATA_CELL", "COUNT", "VARIANCE"]
    return part.select(*columns).unionByName(total.withColumn("DATA_CELL", F.lit(1)).select(*columns))


def _half(part: DataFrame, suffix: str) -> DataFrame:
    return part.select(
        "REGION_ID",
        "REGION_TYPE",
        "ITERATION_CODE",
        "DATA_CELL",
        F.col("COUNT").alias(f"COUNT_NOISY_{suffix}"),
        F.col("VARIANCE").alias(f"VARIANCE_{suffix}"),
        margin_of_error(F.col("VARIANCE")).alias(f"MOE_NOISY_{suffix}"),
    )


def ratio_table(num: DataFrame, den: DataFrame, by_cell: bool) -> DataFrame:
    """Numerator and denominator side by side with their noisy ratio.

    ``by_cell`` pairs the cells of both and adds a total to both; otherwise every numerator cell meets
    the one denominator of its region and iteration. A zero denominator gives a null ratio.
    """
    num = _half(with_total_cell(num), "NUM")
    if by_cell:
        joined = join_num_denom_by_cell(num, _half(with_total_cell(den), "DENOM"))
    else:
        joined = join_num_denom_broadcast_cell(num, _half(den, "DENOM"))
    ratio = F.try_divide(F.col("COUNT_NOISY_NUM").cast("double"), F.col("COUNT_NOISY_DENOM"))
    return joined.withColumn("RATIO_NOISY", ratio).withColumn(
        "GEOID", pad_region_id(F.col("REGION_ID"))
    ).drop("REGION_ID")


_GROUP = ["GEOID", "REGION_TYPE", "ITERATION_CODE"]


def _spread_out(df: DataFrame) -> DataFrame:
    """Rows hashed by group over all cores.

    Few bytes but much computing per group: without a fixed number of partitions, adaptive execution
    would merge such small partitions into one task.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *_GROUP)


def _rng(*key) -> np.random.Generator:
    """Generator seeded by the group, so that a re-run of a lost task repeats its draws."""
    return np.random.default_rng([SEED, zlib.crc32("|".join(map(str, key)).encode())])


_COUNT_SCHEMA = (
    "GEOID string, REGION_TYPE string, ITERATION_CODE string, DATA_CELL int, COUNT_NOISY double, "
    "VARIANCE double, MOE_NOISY double, PRED double, PRED_LO double, PRED_HI double"
)


def posterior_mean(noisy: np.ndarray, variance: np.ndarray) -> np.ndarray:
    """Mean of a normal around the noisy count, kept above zero, rounded."""
    sd = np.sqrt(variance)
    safe = np.where(sd > 0, sd, 1.0)
    mean = np.where(sd > 0, noisy + sd * hazard(-noisy / safe), np.maximum(noisy, 0))
    return np.round(np.maximum(mean, 0))


def posterior_count(tables: DataFrame, margins: Mapping[int, Sequence[int]]) -> DataFrame:
    """Point estimates and intervals for the output of ``marginal_cells``.

    Leaves: closed forms of the truncated normal; the mean is rounded, the interval widened to whole
    numbers. Margins: the mean is the sum of the rounded leaves, the interval that of the sum of the leaves'
    distributions. Nothing is drawn.
    """
    margins = {int(k): list(v) for k, v in margins.items()}

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("DATA_CELL").reset_index(drop=True)
        z = group["COUNT_NOISY"].to_numpy(dtype=float)
        v = group["VARIANCE"].to_numpy(dtype=float)
        sd = np.sqrt(v)
        cells = group["DATA_CELL"].to_numpy()
        pred = posterior_mean(z, v)
        low, high = np.maximum(z, 0), np.maximum(z, 0)
        noisy = sd > 0
        low[noisy] = truncated_quantile(np.full(noisy.sum(), ALPHA), z[noisy], sd[noisy], 0.0)
        high[noisy] = truncated_quantile(np.full(noisy.sum(), 1 - ALPHA), z[noisy], sd[noisy], 0.0)
        for i, cell in enumerate(cells):
            if cell in margins:
                parts = np.isin(cells, margins[cell])
                pred[i] = pred[parts].sum()
                low[i], high[i] = sum_quantiles(z[parts], sd[parts], [ALPHA, 1 - ALPHA])
        group["PRED"], group["PRED_LO"], group["PRED_HI"] = pred, np.floor(low), np.ceil(high)
        return group

    typed = tables.select(
        "GEOID",
        "REGION_TYPE",
        "ITERATION_CODE",
        F.col("DATA_CELL").cast("int"),
        F.col("COUNT_NOISY").cast("double"),
        F.col("VARIANCE").cast("double"),
        F.col("MOE_NOISY").cast("double"),
    )
    return _spread_out(typed).groupBy(*_GROUP).applyInPandas(fit, _COUNT_SCHEMA)


def _chains(
    u: np.ndarray, mean: np.ndarray, sd: np.ndarray, caps: np.ndarray, floor: float, least: float, most: float, signed: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Draws of numerators and denominator d >= 1 from independent normals under least * d <= sum <= most * d.

    Groups and chains go side by side: ``u`` holds uniform numbers by (group, step, coordinate, chain); ``mean``, ``sd`` and
    ``caps`` by (coordinate, group, 1), the denominator last. Beside ``caps``, the slack of both ratio bounds ends
    DEVIATIONS above its noisy value (its size, unless ``signed``). Numerators stay above ``floor``.
    """
    sd = np.maximum(sd, 1e-9)
    top, bottom = mean[:-1].sum(axis=0), mean[-1]
    spread = (sd[:-1] ** 2).sum(axis=0)
    above, below = top - least * bottom, most * bottom - top
    if not signed:
        above, below = np.abs(above), np.abs(below)
    above = np.maximum(above + DEVIATIONS * np.sqrt(spread + (least * sd[-1]) ** 2), 0.0)
    below = np.maximum(below + DEVIATIONS * np.sqrt(spread + (most * sd[-1]) ** 2), 0.0)
    shape = (mean.shape[1], u.shape[-1])
    x = [np.broadcast_to(np.maximum(m, 0.5), shape).copy() for m in mean[:-1]]
    d = np.broadcast_to(np.maximum(bottom, 1.0), shape)
    total = sum(x)
    d = np.maximum(d, total / most)
    x[-1] += np.maximum(least * d - total, 0.0)
    tops, bottoms = [], []
    for step in range(u.shape[1]):
        for i in range(len(x)):
            rest = sum(x) - x[i]
            low = np.maximum(np.maximum(floor, least * d - rest), most * d - below - rest)
            high = np.minimum(np.minimum(caps[i], most * d - rest), least * d + above - rest)
            x[i] = truncated_points(u[:, step, i], mean[i], sd[i], low, np.maximum(low, high))
        total = sum(x)
        low = np.maximum(np.maximum(1.0, total / most), (total - above) / least)
        high = np.minimum(np.minimum(caps[-1], total / least), (total + below) / most)
        # the bounds of the ratio itself hold in any case
        high = np.maximum(np.minimum(np.maximum(low, high), np.maximum(total / least, 1.0)), np.maximum(1.0, total / most))
        d = truncated_points(u[:, step, -1], mean[-1], sd[-1], np.minimum(low, high), high)
        if step >= BURN_IN:
            tops.append(np.stack(x))
            bottoms.append(d)
    return np.concatenate(tops, axis=-1), np.concatenate(bottoms, axis=-1)


def _uniforms(keys: Sequence[tuple], coordinates: int, draws: int) -> np.ndarray:
    """Uniform numbers of each group from its own generator, whatever batch it comes in."""
    return np.stack([_rng(*k).random((BURN_IN - (-draws // CHAINS), coordinates, CHAINS)) for k in keys])


def _summary(top: np.ndarray, bottom: np.ndarray) -> list[np.ndarray]:
    """Mean and interval of the ratio by group."""
    ratio = top / bottom
    low, high = np.quantile(ratio, [ALPHA, 1 - ALPHA], axis=1)
    return [ratio.mean(axis=1), low, high]


def _blocks(n: int) -> list[slice]:
    return [slice(i, i + BLOCK) for i in range(0, n, BLOCK)]


_TWO_PART_SCHEMA = (
    "GEOID string, REGION_TYPE string, ITERATION_CODE string, DATA_CELL int, COUNT_NOISY_NUM double, "
    "VARIANCE_NUM double, MOE_NOISY_NUM double, COUNT_NOISY_DENOM double, VARIANCE_DENOM double, "
    "MOE_NOISY_DENOM double, RATIO_NOISY double, RATIO_PRED double, PRED_NUM double, "
    "PRED_DENOM double, RATIO_PRED_LO double, RATIO_PRED_HI double"
)
_ONE_PART_SCHEMA = (
    "GEOID string, REGION_TYPE string, ITERATION_CODE string, DATA_CELL int, COUNT_NOISY_DENOM double, "
    "VARIANCE_DENOM double, MOE_NOISY_DENOM double, COUNT_NOISY_NUM double, VARIANCE_NUM double, "
    "MOE_NOISY_NUM double, RATIO_NOISY double, RATIO_PRED double, RATIO_PRED_LO double, "
    "RATIO_PRED_HI double"
)
_INTS = ("DATA_CELL",)


def _typed(df: DataFrame, schema: str, missing: Sequence[str]) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]
    return df.select(
        *[
            F.col(n) if n in ("GEOID", "REGION_TYPE", "ITERATION_CODE")
            else F.col(n).cast("int" if n in _INTS else "double")
            for n in names
            if n not in missing
        ]
    )


_SIX = ["__n2", "__n3", "__d", "__v2", "__v3", "__vd"]


def posterior_ratio_two_part(
    table: DataFrame, least: float, most: float = TRUN, draws: int = DRAWS
) -> DataFrame:
    """Ratio estimates for cells 1-3 of a table whose two numerator cells share one denominator.

    ``least`` is the smallest possible total ratio: 1 person per household, 2 per family. Each coordinate
    stays below DEVIATIONS deviations above its noisy value. A cell that is absent counts 0 without noise.
    """
    names = [p.split()[0] for p in _TWO_PART_SCHEMA.split(", ")]

    def fit(batches):
        for batch in batches:
            # rows carry the noisy values of their group, whose draws are made once a batch
            groups = batch.drop_duplicates(_GROUP).reset_index(drop=True)
            found = []
            for block in _blocks(len(groups)):
                part = groups.iloc[block]
                six = part[_SIX].to_numpy(dtype=float).T[:, :, None]
                mean, sd = six[:3], np.sqrt(six[3:])
                keys = [(*k, least) for k in part[_GROUP].itertuples(index=False)]
                tops, bottom = _chains(_uniforms(keys, 3, draws), mean, sd, mean + DEVIATIONS * sd, 0.0, least, most, True)
                for cell, top in ((1, tops.sum(axis=0)), (2, tops[0]), (3, tops[1])):
                    ratio, low, high = _summary(top, bottom)
                    values = dict(zip(_GROUP, [part[g].to_numpy() for g in _GROUP]))
                    found.append(
                        pd.DataFrame(
                            {
                                **values,
                                "DATA_CELL": np.int32(cell),
                                "RATIO_PRED": ratio,
                                "PRED_NUM": top.mean(axis=1),
                                "PRED_DENOM": bottom.mean(axis=1),
                                "RATIO_PRED_LO": low,
                                "RATIO_PRED_HI": high,
                            }
                        )
                    )
            if found:
                yield batch.merge(pd.concat(found), on=[*_GROUP, "DATA_CELL"], how="left")[names]

    missing = ["RATIO_PRED", "PRED_NUM", "PRED_DENOM", "RATIO_PRED_LO", "RATIO_PRED_HI"]
    group = Window.partitionBy(*_GROUP)

    def of(column: str, cell: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("DATA_CELL") == cell, F.col(column))).over(group), F.lit(0.0))

    places = [("COUNT_NOISY_NUM", 2), ("COUNT_NOISY_NUM", 3), ("COUNT_NOISY_DENOM", 1)]
    places += [("VARIANCE_NUM", 2), ("VARIANCE_NUM", 3), ("VARIANCE_DENOM", 1)]
    typed = _spread_out(_typed(table, _TWO_PART_SCHEMA, missing))
    carried = typed.select("*", *[of(c, cell).alias(name) for name, (c, cell) in zip(_SIX, places)])
    return carried.mapInPandas(fit, _TWO_PART_SCHEMA)


def posterior_ratio_one_part(
    table: DataFrame, least: float = 1.0, most: float = TRUN, draws: int = DRAWS
) -> DataFrame:
    """Ratio estimates per row for a table whose cells have a denominator of their own.

    Rows are independent, so this is a map over Arrow batches.
    """
    names = [p.split()[0] for p in _ONE_PART_SCHEMA.split(", ")]

    def fit(batches):
        for batch in batches:
            known = batch.fillna(0.0)
            stats = []
            for block in _blocks(len(batch)):
                part = known.iloc[block]
                mean = part[["COUNT_NOISY_NUM", "COUNT_NOISY_DENOM"]].to_numpy(dtype=float).T[:, :, None]
                sd = np.sqrt(part[["VARIANCE_NUM", "VARIANCE_DENOM"]].to_numpy(dtype=float).T[:, :, None])
                keys = list(part[[*_GROUP, "DATA_CELL"]].itertuples(index=False))
                caps = np.stack([np.full(mean[0].shape, np.inf), np.abs(mean[1]) + DEVIATIONS * sd[1]])
                tops, bottom = _chains(_uniforms(keys, 2, draws), mean, sd, caps, -np.inf, least, most, False)
                stats.append(_summary(tops[0], bottom))
            if stats:
                ratio, low, high = np.concatenate(stats, axis=1)
                yield batch.assign(RATIO_PRED=ratio, RATIO_PRED_LO=low, RATIO_PRED_HI=high)[names]

    missing = ["RATIO_PRED", "RATIO_PRED_LO", "RATIO_PRED_HI"]
    return _spread_out(_typed(table, _ONE_PART_SCHEMA, missing)).mapInPandas(fit, _ONE_PART_SCHEMA)


def model_summary_counts(estimates: DataFrame) -> DataFrame:
    """Per table, noisy against smoothed: min, max, share not positive, median interval length."""
    both = estimates.select(
        "TABLE",
        F.inline(
            F.array(
                F.struct(
                    F.lit("NM").alias("KIND"),
                    F.col("COUNT_NOISY").cast("double").alias("v"),
                    (F.col("MOE_NOISY") * 2).alias("len"),
                ),
                F.struct(
                    F.lit("PRED").alias("KIND"),
                    F.col("PRED").cast("double").alias("v"),
                    (F.col("PRED_HI") - F.col("PRED_LO")).cast("double").alias("len"),
                ),
            )
        ),
    )
    basic = both.groupBy("TABLE", "KIND").agg(
        F.min("v").alias("MIN"),
        F.max("v").alias("MAX"),
        (F.avg(F.when(F.col("v") <= 0, 1.0).otherwise(0.0)) * 100).alias("P_NEG"),
    )
    median = exact_percentile(both, ["TABLE", "KIND"], "len", 0.5, "LEN").drop("LEN_n")
    return basic.join(median, ["TABLE", "KIND"])


def model_summary_ratios(estimates: DataFrame, trun: float = TRUN) -> DataFrame:
    """Per table, noisy against smoothed: min, max, share out of bounds, mean interval length."""
    least = F.when(F.col("TABLE") == "PH5", F.lit(2.0)).otherwise(F.lit(1.0))
    both = estimates.select(
        "TABLE",
        "DATA_CELL",
        F.inline(
            F.array(
                F.struct(
                    F.lit("NM").alias("KIND"),
                    F.col("RATIO_NOISY").alias("v"),
                    F.lit(None).cast("double").alias("len"),
                ),
                F.struct(
                    F.lit("PRED").alias("KIND"),
                    F.col("RATIO_PRED").alias("v"),
                    (F.col("RATIO_PRED_HI") - F.col("RATIO_PRED_LO")).alias("len"),
                ),
            )
        ),
    )
    v = F.col("v")
    bad = F.when(F.col("DATA_CELL") == 1, (v < least) | (v > trun)).otherwise(v < 0)
    return both.groupBy("TABLE", "KIND").agg(
        F.min("v").alias("MIN"),
        F.max("v").alias("MAX"),
        (F.avg(F.when(bad, 1.0).otherwise(0.0)) * 100).alias("P_BAD"),
        F.avg("len").alias("LEN"),
    )
