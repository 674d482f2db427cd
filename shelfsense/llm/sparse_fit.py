"""Sparse logistic regression on a bounded sample of feature lists, fitted in one executor task.

The sample has a documented bound, so one task holds it as flat arrays; the driver sees the weights that are not
zero and nothing else. The method is quasi-Newton in the orthant of the current weights, so a weight that the
penalty holds at zero is exactly zero.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

ITERATIONS = 60
MEMORY = 10
TOLERANCE = 1e-6


def orthant_descent(loss, start: np.ndarray, penalty: np.ndarray, iterations: int = ITERATIONS, memory: int = MEMORY, tolerance: float = TOLERANCE) -> np.ndarray:
    """Weights of the smallest ``loss(w)[0] + sum(penalty * |w|)``; ``loss`` gives value and gradient."""
    w = start.copy()
    value, slope = loss(w)
    value += float(penalty @ np.abs(w))
    past: deque = deque(maxlen=memory)
    for _ in range(iterations):
        up, down = slope + penalty, slope - penalty
        steepest = np.where(w > 0, up, np.where(w < 0, down, np.where(up < 0, up, np.where(down > 0, down, 0.0))))
        direction, kept = -steepest, []
        for s, y, rho in reversed(past):
            a = rho * (s @ direction)
            direction = direction - a * y
            kept.append(a)
        if past:
            s, y, rho = past[-1]
            direction = direction / (rho * (y @ y))
        for (s, y, rho), a in zip(past, reversed(kept)):
            direction = direction + (a - rho * (y @ direction)) * s
        direction = np.where(direction * -steepest > 0, direction, 0.0)
        if not direction.any():
            break
        side = np.where(w != 0, np.sign(w), -np.sign(steepest))
        step = 1.0 if past else 1.0 / np.linalg.norm(direction)
        for _ in range(40):
            moved = w + step * direction
            moved = np.where((penalty > 0) & (moved * side < 0), 0.0, moved)
            new_value, new_slope = loss(moved)
            new_value += float(penalty @ np.abs(moved))
            if new_value <= value + 1e-4 * (steepest @ (moved - w)):
                break
            step /= 2
        else:
            break
        s, y = moved - w, new_slope - slope
        if s @ y > 1e-10:
            past.append((s, y, 1.0 / (s @ y)))
        gain = (value - new_value) / max(abs(value), abs(new_value), 1e-6)
        w, value, slope = moved, new_value, new_slope
        if gain < tolerance:
            break
    return w


def fit_lists(columns: np.ndarray, lengths: np.ndarray, labels: np.ndarray, n_features: int, penalty: float, iterations: int = ITERATIONS) -> tuple[float, np.ndarray]:
    """Bias and weights of the mean logistic loss plus ``penalty`` times the sum of absolute weights.

    Row i holds the next ``lengths[i]`` of ``columns``; the bias is not penalised.
    """
    rows, n = np.repeat(np.arange(len(lengths)), lengths), len(labels)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = w[-1] + np.bincount(rows, w[columns], n)
        off = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) / n
        slope = np.bincount(columns, off[rows], n_features + 1)
        slope[-1] = off.sum()
        return float(np.mean(np.logaddexp(0, z) - labels * z)), slope

    share = labels.mean()
    start = np.zeros(n_features + 1)
    start[-1] = np.log(share / (1 - share))
    cost = np.full(n_features + 1, penalty)
    cost[-1] = 0.0
    w = orthant_descent(loss, start, cost, iterations)
    return float(w[-1]), w[:-1]


def _fitted(penalty: float, least: int, iterations: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, labels, names = [], [], []
        for batch in batches:
            lengths.append(np.diff(batch.column(0).offsets.to_numpy()))
            labels.append(batch.column(1).to_numpy())
            names.append(batch.column(0).flatten())
        if not names:
            return
        lengths, labels = np.concatenate(lengths), np.concatenate(labels)
        coded = pa.chunked_array(names, pa.string()).combine_chunks().dictionary_encode()
        del names
        codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        chosen = np.flatnonzero(np.bincount(codes, minlength=len(words)) >= least)
        number = np.full(len(words), -1)
        number[chosen] = np.arange(len(chosen))
        columns = number[codes]
        rows = np.repeat(np.arange(len(lengths)), lengths)[columns >= 0]
        columns = columns[columns >= 0]
        del coded, codes, number
        bias, weights = fit_lists(columns, np.bincount(rows, minlength=len(lengths)), labels, len(chosen), penalty, iterations)
        used = np.flatnonzero(weights)
        features = pc.take(words, pa.array(chosen[used]))
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([bias])], names=["feature", "weight"])
        yield pa.RecordBatch.from_arrays([features, pa.array(weights[used])], names=["feature", "weight"])
        del words, features, rows, columns
        pa.default_memory_pool().release_unused()  # the worker lives on and may serve other stages

    return run


def fit(listed: DataFrame, penalty: float, least: int, iterations: int = ITERATIONS) -> DataFrame:
    """``(feature, weight)`` from ``(features, label)``: distinct features per row, labels 0 and 1, both present.

    ``listed`` must have a bounded number of rows, since one task fits. Features of fewer than ``least`` rows are left
    out. The row without a feature is the bias; an empty table gives no row.
    """
    return listed.select("features", "label").coalesce(1).mapInArrow(_fitted(penalty, least, iterations), "feature string, weight double")
