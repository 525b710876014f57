"""Logistic regression on bounded samples, with sparse counts and dense columns."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np


@dataclass(frozen=True)
class Rows:
    """Sparse counts: row i has (index, value)[first[i]:first[i + 1]]; dense: (rows, d)."""

    first: np.ndarray
    index: np.ndarray
    value: np.ndarray
    dense: np.ndarray

    def take(self, rows: np.ndarray) -> Rows:
        size = np.diff(self.first)[rows]
        first = np.append(0, np.cumsum(size))
        place = np.arange(first[-1]) - np.repeat(first[:-1], size) + np.repeat(self.first[rows], size)
        return Rows(first, self.index[place], self.value[place], self.dense[rows])

    def beside(self, column: np.ndarray) -> Rows:
        """With one more dense column."""
        return replace(self, dense=np.column_stack([self.dense, column]))

    def __len__(self) -> int:
        return len(self.first) - 1


class Model(NamedTuple):
    sparse: np.ndarray
    dense: np.ndarray
    bias: float

    def score(self, rows: Rows) -> np.ndarray:
        """The log-odds of each row."""
        owner = np.repeat(np.arange(len(rows)), np.diff(rows.first))
        words = np.bincount(owner, self.sparse[rows.index] * rows.value, len(rows)) if len(rows.index) else 0.0
        return words + rows.dense @ self.dense + self.bias


def probability(score: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(score, -40, 40)))


def fit(rows: Rows, truth: np.ndarray, features: int, penalty: float = 1.0, steps: int = 300) -> Model:
    """L2-penalised logistic regression by accelerated gradient steps, each feature
    scaled by its curvature bound. Without both classes only the bias is fitted."""
    count, dense = len(rows), rows.dense.shape[1]
    rate = (truth.sum() + 0.5) / (count + 1)
    weights = np.zeros(features + dense + 1)
    weights[-1] = np.log(rate / (1 - rate))
    if count and 0 < truth.sum() < count:
        owner = np.repeat(np.arange(count), np.diff(rows.first))
        total = np.bincount(owner, np.abs(rows.value), count) + np.abs(rows.dense).sum(axis=1) + 1
        curve = np.concatenate(
            [
                np.bincount(rows.index, np.abs(rows.value) * total[owner], features),
                np.abs(rows.dense).T @ total,
                [total.sum()],
            ]
        )
        # a bound on the Hessian by its row sums
        step = 1 / (curve / 4 + penalty)
        ridge = np.full(len(weights), penalty)
        ridge[-1] = 0
        ahead, momentum = weights.copy(), 1.0
        for _ in range(steps):
            score = rows.dense @ ahead[features:-1] + ahead[-1]
            if len(rows.index):
                score += np.bincount(owner, ahead[rows.index] * rows.value, count)
            error = probability(score) - truth
            slope = np.concatenate(
                [
                    np.bincount(rows.index, error[owner] * rows.value, features),
                    rows.dense.T @ error,
                    [error.sum()],
                ]
            )
            after = ahead - step * (slope + ridge * ahead)
            faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
            ahead = after + (momentum - 1) / faster * (after - weights)
            weights, momentum = after, faster
    return Model(weights[:features], weights[features:-1], float(weights[-1]))


def folds(keys: np.ndarray, count: int) -> np.ndarray:
    """The fold of each key; equal keys, such as copies of one text, share a fold."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(count)).astype(np.int64)
