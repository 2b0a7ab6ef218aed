"""Logistic regression and classification measures."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_vectors(examples: DataFrame) -> DataFrame:
    """Examples with the feature array as an ML vector."""
    return examples.withColumn("feature", array_to_vector("feature"))


def fit(examples: DataFrame, **params) -> LogisticRegressionModel:
    """Logistic regression with Spark's defaults unless ``params`` say else."""
    return LogisticRegression(featuresCol="feature", labelCol="label", **params).fit(
        as_vectors(examples.select("feature", "label"))
    )


def score(model: LogisticRegressionModel, examples: DataFrame) -> DataFrame:
    """Examples with prediction columns."""
    return model.transform(as_vectors(examples))


@dataclass(frozen=True)
class _Group:
    """Where the fit of one group stands: scaled coefficients, the intercept last."""

    mean: np.ndarray
    scale: np.ndarray  # 0 for a constant feature, which gets no coefficient
    at: np.ndarray
    before: np.ndarray
    loss: float = np.inf
    first: float = 0.0
    passes: int = 0
    done: bool = False

    def design(self, features: np.ndarray) -> np.ndarray:
        """Centred and scaled features and a column of ones."""
        scaled = (features - self.mean) * self.scale
        return np.hstack([scaled, np.ones((len(scaled), 1))])

    def model(self) -> tuple[list[float], float]:
        """(coefficients, intercept) for features as they come."""
        weights = self.at[:-1] * self.scale
        return weights.tolist(), float(self.at[-1] - weights @ self.mean)


# Numbers of a sum that travel as one row, and groups whose sums a task holds.
SUM_ROW, HELD_GROUPS = 4096, 32


def _sums(group: _Group, features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Upper half of the Hessian, gradient and loss of some rows, as one array."""
    x = group.design(features)
    margin = x @ group.at
    p = 1.0 / (1.0 + np.exp(-margin))
    weighted = x * np.sqrt(p * (1.0 - p))[:, None]
    loss = np.logaddexp(0.0, margin) - labels * margin
    upper = np.triu_indices(x.shape[1])
    return np.concatenate([(weighted.T @ weighted)[upper], x.T @ (labels - p), [loss.sum()]])


def _advanced(group: _Group, sums: np.ndarray, tolerance: float) -> _Group:
    """The group after one Newton step from the sums of all its rows.

    A step that made the loss larger is halved. Of equally good steps the
    shortest is taken, so features that depend on each other share their weight.
    """
    width = len(group.at)
    loss, gradient, upper = float(sums[-1]), sums[-1 - width : -1], sums[: -1 - width]
    if not loss <= group.loss + 1e-12 * abs(group.loss):
        return replace(group, at=(group.at + group.before) / 2, passes=group.passes + 1)
    first = group.first or loss
    gain = group.loss - loss
    if gain <= tolerance * max(abs(loss), 1e-6 * first):
        return replace(group, loss=loss, first=first, passes=group.passes + 1, done=True)
    hessian = np.zeros((width, width))
    hessian[np.triu_indices(width)] = upper
    hessian += np.triu(hessian, 1).T
    step = np.linalg.pinv(hessian, rcond=1e-10, hermitian=True) @ gradient
    return replace(group, at=group.at + step, before=group.at, loss=loss, first=first, passes=group.passes + 1)


def _starts(examples: DataFrame, key: str) -> dict[str, _Group]:
    """Each group before its first step: no coefficients, the intercept of its share of positives."""
    stats = as_vectors(examples).groupBy(key).agg(
        Summarizer.metrics("mean", "std").summary(F.col("feature")).alias("s"), F.avg("label").alias("positive"))
    out = {}
    for name, mean, std, positive in stats.select(
            key, vector_to_array("s.mean"), vector_to_array("s.std"), "positive").collect():
        mean, std = np.array(mean), np.array(std)
        scale = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
        with np.errstate(divide="ignore"):
            intercept = np.log(positive) - np.log1p(-positive)
        at = np.append(np.zeros(len(mean)), intercept)
        out[name] = _Group(mean, scale, at, at, done=not 0 < positive < 1)
    return out


def fit_groups(examples: DataFrame, key: str, passes: int = 50, tolerance: float = 1e-6) -> DataFrame:
    """(key, coefficients, intercept, passes): one logistic regression per value of ``key``.

    The unregularised fit that :func:`fit` makes of the rows of each group, by
    iteratively reweighted least squares. All groups advance together: a pass over
    the examples sums gradients and Hessians per task and group, the sums are added
    up by group, and each group takes its step on an executor. The driver holds the
    coefficients of the groups. A group with one class has no coefficients and an
    infinite intercept. Groups that are done are not read again; on classes that
    can be separated the loss falls until it is a millionth of the first one.
    Rows without a key are left out.
    """
    spark = examples.sparkSession
    rows = examples.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias(key), "feature", F.col("label").cast("double"))
    groups = _starts(rows, key)
    for _ in range(passes):
        going = {name: g for name, g in groups.items() if not g.done}
        if not going:
            break
        shared = spark.sparkContext.broadcast(going)

        def parts(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
            for name, sums in held.items():
                pieces = [sums[at : at + SUM_ROW] for at in range(0, len(sums), SUM_ROW)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(pieces)), pa.array(range(len(pieces)), pa.int32()),
                    pa.array(pieces, pa.list_(pa.float64()))], names=[key, "piece", "sums"])
            held.clear()

        def one_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[str, np.ndarray] = {}
            for batch in batches:
                names = batch.column(0).to_pandas().to_numpy()
                labels = batch.column(2).to_numpy(zero_copy_only=False)
                features = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(names), -1)
                for name in set(names) & shared.value.keys():
                    mine = names == name
                    if name not in held and len(held) == HELD_GROUPS:
                        yield from parts(held)
                    held[name] = held.get(name, 0.0) + _sums(shared.value[name], features[mine], labels[mine])
            yield from parts(held)

        def step(table: pa.Table) -> pa.Table:
            name, pieces = table.column(0)[0].as_py(), dict(zip(table.column(1).to_pylist(), table.column(2).to_pylist()))
            group = _advanced(shared.value[name], np.concatenate([pieces[i] for i in range(len(pieces))]), tolerance)
            return pa.Table.from_pylist([{
                key: name, "at": group.at.tolist(), "before": group.before.tolist(), "loss": group.loss,
                "first": group.first, "passes": group.passes, "done": group.done}])

        wanted = rows.filter(F.col(key).isin(list(going)))
        summed = (
            wanted.mapInArrow(one_pass, f"{key} string, piece int, sums array<double>")
            .groupBy(key, "piece").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
            .select(key, "piece", vector_to_array("sums").alias("sums"))
        )
        kinds = "at array<double>, before array<double>, loss double, first double, passes long, done boolean"
        for row in summed.groupBy(key).applyInArrow(step, f"{key} string, {kinds}").collect():
            name, at, before, *rest = row
            old = groups[name]
            groups[name] = _Group(old.mean, old.scale, np.array(at), np.array(before), *rest)
        shared.destroy()
    models = [(name, *g.model(), g.passes) for name, g in sorted(groups.items())]
    return spark.createDataFrame(models, f"{key} string, coefficients array<double>, intercept double, passes long")


def margin(feature: Column, coefficients: Column, intercept: Column) -> Column:
    """Log-odds of the positive class."""
    products = F.zip_with(feature, coefficients, lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda a, x: a + x) + intercept


def score_groups(models: DataFrame, examples: DataFrame, key: str) -> DataFrame:
    """Examples of the groups that have a model, with ``prediction``."""
    odds = margin(F.col("feature"), F.col("coefficients"), F.col("intercept"))
    return examples.join(models, key).withColumn("prediction", F.when(odds > 0, 1.0).otherwise(0.0)).drop(
        "coefficients", "intercept", "passes")


def class_metrics(predictions: DataFrame, *keys: str) -> DataFrame:
    """Accuracy, weighted recall and weighted F1: one row, or one per value of ``keys``.

    Computed from the confusion counts in one pass over the predictions.
    """
    counts = predictions.groupBy(*keys, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    label, guess = F.col("label").cast("double"), F.col("prediction").cast("double")
    none = F.lit(0).cast("long")
    parts = F.array(
        F.struct(label.alias("class"), F.col("n").alias("actual"), none.alias("guessed"),
                 F.when(label == guess, F.col("n")).otherwise(none).alias("hits")),
        F.struct(guess.alias("class"), none.alias("actual"), F.col("n").alias("guessed"),
                 none.alias("hits")),
    )
    classes = counts.select(*keys, F.inline(parts)).groupBy(*keys, "class").agg(
        *(F.sum(c).alias(c) for c in ("actual", "guessed", "hits"))
    )
    total = F.sum("actual")
    # With p = hits/guessed and r = hits/actual, F1 = 2 hits / (guessed + actual).
    f1 = F.col("actual") * 2 * F.col("hits") / (F.col("guessed") + F.col("actual"))
    recall = F.when(F.col("actual") > 0, F.col("actual") * (F.col("hits") / F.col("actual")))
    return classes.groupBy(*keys).agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(F.coalesce(recall, F.lit(0.0))) / total).alias("weighted_recall"),
        (F.sum(f1) / total).alias("weighted_f1"),
    )
