"""Training by full gradients: tasks add up the gradient of their rows, sums are combined in a tree, L-BFGS steps on the driver.

Several models with parameters of one size, such as the folds of a cross-validation, share every pass over the rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.operators.neighbours import matrix
from tabscope.session import ship

# Entries of a gradient that travel as one row, rows that a task sees at once, and sums that one task combines.
CHUNK, ROWS_AT_ONCE, FAN = 4096, 4096, 64
MEMORY = 10


class Model(Protocol):
    def loss(self, parameters: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
        """Sum of the weighted losses of some rows, and its gradient."""

    def penalty(self, parameters: np.ndarray) -> tuple[float, np.ndarray]: ...


class Perceptron:
    """Hidden layers of rectified units under a softmax; weighted cross-entropy."""

    def __init__(self, layers: Sequence[int]) -> None:
        self.layers = list(layers)

    def start(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        parts = []
        for a, b in zip(self.layers[:-1], self.layers[1:], strict=True):
            parts += [rng.normal(0.0, np.sqrt(2.0 / a), (a, b)).ravel(), np.zeros(b)]
        return np.concatenate(parts)

    def _unpacked(self, parameters: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out, at = [], 0
        for a, b in zip(self.layers[:-1], self.layers[1:], strict=True):
            out.append((parameters[at : at + a * b].reshape(a, b), parameters[at + a * b : at + a * b + b]))
            at += a * b + b
        return out

    def _forward(self, parameters: np.ndarray, x: np.ndarray) -> tuple[list, list[np.ndarray], np.ndarray]:
        weights = self._unpacked(parameters)
        values = [x]
        for k, (w, b) in enumerate(weights):
            z = values[-1] @ w + b
            values.append(np.maximum(z, 0) if k < len(weights) - 1 else z)
        top = values[-1] - values[-1].max(1, keepdims=True)
        return weights, values, top - np.log(np.exp(top).sum(1, keepdims=True))

    def log_probabilities(self, parameters: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self._forward(parameters, x)[2]

    def loss(self, parameters: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
        weights, values, logs = self._forward(parameters, x)
        rows = np.arange(len(y))
        back = np.exp(logs)
        back[rows, y] -= 1
        back *= w[:, None]
        parts = []
        for k in range(len(weights) - 1, -1, -1):
            parts += [back.sum(0), (values[k].T @ back).ravel()]
            if k:
                back = (back @ weights[k][0].T) * (values[k] > 0)
        return float(-(w * logs[rows, y]).sum()), np.concatenate(parts[::-1])

    def penalty(self, parameters: np.ndarray) -> tuple[float, np.ndarray]:
        return 0.0, np.zeros_like(parameters)


class KernelSvm:
    """Machines for all classes at once (one for two classes) on random Fourier features, with squared hinge loss.

    The features (Rahimi and Recht, 2007) have inner products near exp(-gamma |x - y|^2), so no rows x rows matrix is made;
    they are computed where they are used. Every class is told from the rest by one column of one matrix, so ten classes
    cost one pass like two.
    """

    def __init__(self, size: int, dimensions: int, classes: int, gamma: float, regularisation: float, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.directions = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(size, dimensions))
        self.offsets = rng.uniform(0.0, 2.0 * np.pi, size=dimensions)
        self.columns = 1 if classes == 2 else classes
        self.regularisation = regularisation

    def start(self) -> np.ndarray:
        return np.zeros((len(self.offsets) + 1) * self.columns)

    def features(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(2.0 / len(self.offsets)) * np.cos(x @ self.directions + self.offsets)

    def scores(self, parameters: np.ndarray, x: np.ndarray) -> np.ndarray:
        w = parameters.reshape(-1, self.columns)
        return self.features(x) @ w[:-1] + w[-1]

    def loss(self, parameters: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
        weights, z = parameters.reshape(-1, self.columns), self.features(x)
        sign = np.where(y[:, None] == (np.arange(self.columns) if self.columns > 1 else 1), 1.0, -1.0)
        short = np.maximum(0.0, 1.0 - sign * (z @ weights[:-1] + weights[-1]))
        back = -2.0 * w[:, None] * sign * short
        return float((w[:, None] * short * short).sum()), np.concatenate([z.T @ back, back.sum(0)[None]]).ravel()

    def penalty(self, parameters: np.ndarray) -> tuple[float, np.ndarray]:
        w = parameters.reshape(-1, self.columns).copy()
        w[-1] = 0.0
        return 0.5 * self.regularisation * float((w * w).sum()), self.regularisation * w.ravel()


def gradient_sums(
    rows: DataFrame, model: Model, parameters: np.ndarray, held_out: Sequence[int], few: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Weighted mean loss and its gradient for each row of ``parameters``, in one pass.

    ``rows``: x array, y long, w double, fold int. Model k does not see the rows whose fold is ``held_out[k]``. What a task returns
    is the size of the parameters, whatever its rows. Tasks combine those sums to one of each chunk before they are collected,
    so the driver gets the size of the parameters, whatever the number of tasks; with ``few`` the caller knows that one step
    is enough (``few_tasks``), else they are first combined to ``FAN``.
    """
    spark = rows.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(parameters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = shared.value
        total = np.zeros((len(given), given.shape[1] + 2))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                x = matrix(part.column("x"))
                y, w, fold = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "fold"))
                for k, out in enumerate(held_out):
                    seen = np.flatnonzero(fold != out)
                    if len(seen):
                        loss, gradient = model.loss(given[k], x[seen], y[seen], w[seen])
                        total[k, 0] += loss
                        total[k, 1] += w[seen].sum()
                        total[k, 2:] += gradient
        number = TaskContext.get().partitionId()
        for k in range(len(given)):
            for chunk, at in enumerate(range(0, total.shape[1], CHUNK)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], pa.int32()) for v in (k, chunk, number)] + [pa.array([total[k, at : at + CHUNK]])], ["model", "chunk", "task", "part"]
                )

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("task")  # one order of the terms, however they arrive
        first = frame.iloc[0]
        return pd.DataFrame({"model": [first["model"]], "chunk": [first["chunk"]], "task": [first["task"] % FAN], "part": [np.sum(np.stack(frame["part"]), 0)]})

    schema = "model int, chunk int, task int, part array<double>"
    found = rows.select("x", "y", "w", "fold").mapInArrow(run, schema)
    if not few:
        found = found.groupBy("model", "chunk", F.pmod("task", F.lit(FAN))).applyInPandas(lambda f: added(f), schema)
    found = found.groupBy("model", "chunk").applyInPandas(lambda f: added(f), schema)
    out = {(r["model"], r["chunk"]): np.array(r["part"]) for r in found.collect()}
    shared.destroy()
    chunks = 1 + max(c for _, c in out)
    total = np.stack([np.concatenate([out[k, c] for c in range(chunks)]) for k in range(len(parameters))])
    weight = np.maximum(total[:, 1:2], 1e-300)
    loss, gradient = total[:, 0] / weight[:, 0], total[:, 2:] / weight
    for k, p in enumerate(parameters):
        extra, slope = model.penalty(p)
        loss[k] += extra
        gradient[k] += slope
    return loss, gradient


def few_tasks(rows: DataFrame) -> bool:
    """Whether a pass over a stored table takes at most ``FAN`` tasks."""
    last = rows.select("w", F.spark_partition_id().alias("task")).agg(F.max("task"), F.count("w")).first()[0]
    return (last or 0) < FAN


def minimise(evaluate: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], start: np.ndarray, iterations: int, tolerance: float = 1e-6) -> np.ndarray:
    """L-BFGS for several independent functions side by side; each row of ``start`` belongs to one.

    ``evaluate`` gives the values and gradients of all of them at once. A step that does not lower its function enough
    is halved in the next round; functions whose value settles (relative change below ``tolerance``) stay where they are.
    """
    x = start.copy()
    value, slope = evaluate(x)
    memory = [deque(maxlen=MEMORY) for _ in x]
    direction = np.stack([_direction(g, m) for g, m in zip(slope, memory, strict=True)])
    step = np.minimum(1.0, 1.0 / np.maximum(np.linalg.norm(slope, axis=1), 1e-12))
    done, taken, tries = np.zeros(len(x), bool), np.zeros(len(x), int), np.zeros(len(x), int)
    while not done.all():
        trial = np.where(done[:, None], x, x + step[:, None] * direction)
        new_value, new_slope = evaluate(trial)
        for k in np.flatnonzero(~done):
            enough = value[k] + 1e-4 * step[k] * float(slope[k] @ direction[k])
            if not new_value[k] <= enough:
                step[k] /= 2
                tries[k] += 1
                done[k] = tries[k] > 20
                continue
            moved, turned = trial[k] - x[k], new_slope[k] - slope[k]
            if moved @ turned > 1e-12:
                memory[k].append((moved, turned))
            settled = abs(value[k] - new_value[k]) <= tolerance * max(abs(value[k]), abs(new_value[k]), 1e-12)
            x[k], value[k], slope[k] = trial[k], new_value[k], new_slope[k]
            taken[k] += 1
            done[k] = settled or taken[k] >= iterations
            direction[k], step[k], tries[k] = _direction(slope[k], memory[k]), 1.0, 0
    return x


def _direction(gradient: np.ndarray, memory: deque) -> np.ndarray:
    """Downhill, by the two-loop recursion."""
    q, kept = gradient.copy(), []
    for s, y in reversed(memory):
        a = (s @ q) / (y @ s)
        q -= a * y
        kept.append(a)
    if memory:
        s, y = memory[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(memory, reversed(kept), strict=True):
        q += (a - (y @ q) / (y @ s)) * s
    return -q
