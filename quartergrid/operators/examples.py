"""Splits, scaling, look-back sequences and sampled training examples."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartergrid.config import KEEP_SHARE, LOOKBACK, SCALED_COLUMNS, STEP_FEATURES, TRAIN_SHARE
from quartergrid.functions.labels import hour_onehot, keyed_draw


def last_steps(grid: DataFrame) -> DataFrame:
    """(city, last_step) of every city in the grid."""
    return grid.groupBy("city").agg(F.max("step").alias("last_step"))


def chrono_split(grid: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """Add ``split``: train up to 5/6 of the city's last step, then test.

    ``ends`` is a stored :func:`last_steps`: Spark then knows that it is small
    and leaves the grid where it lies.
    """
    part, whole = TRAIN_SHARE
    known = last_steps(grid) if ends is None else ends
    split = F.when(F.col("step") * whole <= F.col("last_step") * part, "train").otherwise("test")
    return grid.join(known, "city").withColumn("split", split).drop("last_step")


def step_extremes(grid: DataFrame, columns=SCALED_COLUMNS) -> DataFrame:
    """(city, step) with the least and greatest value of each column: one pass over the grid.

    Small, and it tells both the last steps and, once these are known, the train ranges.
    """
    return grid.groupBy("city", "step").agg(
        *(F.min(c).alias(f"{c}_least") for c in columns), *(F.max(c).alias(f"{c}_most") for c in columns))


def train_ranges(split_grid: DataFrame, columns=SCALED_COLUMNS) -> DataFrame:
    """(city, ranges): minimum and width of each column over the train rows.

    A constant column gets width 1. Takes the grid or its :func:`step_extremes`.
    """
    ends = {c: (f"{c}_least", f"{c}_most") if f"{c}_least" in split_grid.columns else (c, c) for c in columns}

    def width(c: str) -> Column:
        least, most = ends[c]
        span = (F.max(most) - F.min(least)).cast("double")
        return F.when(span == 0, 1.0).otherwise(span)

    return (
        split_grid.filter("split = 'train'")
        .groupBy("city")
        .agg(*(F.min(ends[c][0]).cast("double").alias(f"{c}_low") for c in columns),
             *(width(c).alias(f"{c}_width") for c in columns))
        .select("city", F.struct(
            *(F.col(f"{c}_{part}") for c in columns for part in ("low", "width"))
        ).alias("ranges"))
    )


def scale_by_train(
    split_grid: DataFrame, columns=SCALED_COLUMNS, ranges: DataFrame | None = None
) -> DataFrame:
    """Scale columns by the train range of their city, without clipping.

    ``ranges`` is a stored :func:`train_ranges`, if there is one.
    """
    known = train_ranges(split_grid, columns) if ranges is None else ranges
    scaled = {
        c: (F.col(c) - F.col(f"ranges.{c}_low")) / F.col(f"ranges.{c}_width") for c in columns
    }
    return split_grid.join(known, "city").withColumns(scaled).drop("ranges")


def encode_hours(grid: DataFrame) -> DataFrame:
    """Replace the part of the day by five 0/1 columns at the end."""
    return grid.select("*", *hour_onehot(F.col("hod_cat"))).drop("hod_cat")


def step_vector(columns=STEP_FEATURES) -> Column:
    """The features of one step as an array."""
    return F.array(*(F.col(c).cast("double") for c in columns))


def is_kept(label: Column, seed: int, keep_share: float = KEEP_SHARE) -> Column:
    """Every positive, and the share of negatives their keyed draw selects."""
    edge = round(10000 * (1 - keep_share))
    return (label > 0) | (keyed_draw(seed, F.col("cell"), F.col("step")) >= edge)


def sample_negatives(rows: DataFrame, seed: int, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Rows kept for training or testing."""
    return rows.filter(is_kept(F.col("predicted_accident"), seed, keep_share))


def lookback(
    rows: DataFrame, length: int = LOOKBACK, chosen: Column | None = None, dense: bool = False
) -> DataFrame:
    """Add ``sequence``: the flattened features of the ``length`` rows before.

    Rows are taken per city, cell and split in step order; the first
    ``length`` rows of each have no sequence and are dropped. With ``chosen``
    only the rows it marks are returned: rows that no chosen row looks back on
    are filtered out before any sequence is gathered. ``dense`` says that the
    series had a row for every step before rows were left out: a row then counts
    as preceded by ``length`` rows if the steps before it are all there.
    """
    series = Window.partitionBy("city", "cell", "split").orderBy("step")
    if dense:
        before = F.lag("step", length).over(series)
        position = F.when(before == F.col("step") - length, length + 1).otherwise(0)
    else:
        position = F.row_number().over(series)
    placed = rows.withColumn("position", position)
    if chosen is None:
        needed = placed.withColumn("chosen", F.col("position") > length)
    else:
        picked = placed.withColumn("chosen", (F.col("position") > length) & chosen)
        ahead = F.max("chosen").over(series.rowsBetween(1, length))
        needed = picked.withColumn("ahead", F.coalesce(ahead, F.lit(False))).filter(
            "chosen or ahead"
        ).drop("ahead")
    # All rows a chosen row looks back on are still there and adjacent.
    history = F.collect_list("features").over(series.rowsBetween(-length, -1))
    return (
        needed.withColumn("sequence", F.flatten(history))
        .filter("chosen")
        .drop("chosen", "position", "features")
    )


def needed_rows(
    rows: DataFrame, positives: DataFrame, seed: int, keep_share: float = KEEP_SHARE,
    length: int = LOOKBACK,
) -> DataFrame:
    """Rows that are kept examples or within the look-back of one.

    For a grid without gaps in its steps, before anything is shuffled: draws
    follow from cell and step alone, so each row tests the draws of the steps
    that look back on it. ``positives`` (cell, step) adds the steps around the
    accidents; it is as small as accidents are rare.
    """
    edge = round(10000 * (1 - keep_share))
    drawn = [keyed_draw(seed, F.col("cell"), F.col("step") + k) >= edge for k in range(length + 1)]
    around = positives.select(
        "cell", F.explode(F.sequence(F.col("step") - length, F.col("step"))).alias("step")
    ).distinct().withColumn("near", F.lit(True))
    marked = rows.withColumn("drawn", reduce(or_, drawn)).join(around, ["cell", "step"], "left")
    return marked.filter("drawn or near").drop("drawn", "near")


def training_examples(
    clean: DataFrame, cell_features: DataFrame, seed: int, keep_share: float = KEEP_SHARE,
    length: int = LOOKBACK, ends: DataFrame | None = None, ranges: DataFrame | None = None,
    positives: DataFrame | None = None, dealt: bool = False,
) -> DataFrame:
    """(city, split, cell, step, label, feature) of all sampled examples.

    Only rows that a sampled row needs are shuffled, once and by cell, which
    serves the look-back windows and the join with the features of the cell; none
    if ``clean`` is a table dealt out by cell, as ``dealt`` says. ``ends``, ``ranges``
    and ``positives`` (cell, step) may be stored tables.
    """
    split = chrono_split(clean.drop("cell_code"), ends)
    known = positives
    if known is None:
        known = clean.filter("predicted_accident > 0").select("cell", "step")
    near = needed_rows(split, known, seed, keep_share, length)
    rows = encode_hours(scale_by_train(near, ranges=train_ranges(split) if ranges is None else ranges))
    vectors = rows.select(
        "city", "split", "cell", "step", "predicted_accident", step_vector().alias("features"))
    if not dealt:
        vectors = vectors.repartition("cell")
    kept = lookback(vectors, length, is_kept(F.col("predicted_accident"), seed, keep_share), dense=True)
    parts = ("sequence", "poi", "text")
    feature = F.concat(*parts, F.array(F.col("cell_code").cast("double")))
    return kept.join(cell_features, "cell").select(
        "city", "split", "cell", "step",
        F.col("predicted_accident").alias("label"), feature.alias("feature"),
    )
