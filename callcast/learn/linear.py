"""Ridge-penalised logistic regression for many training sets and strengths at once.

Every Newton step is one Spark job over the rows of all training sets: a task adds up
gradient, Hessian and loss of every (training set, strength) over its rows, the driver
solves one small system for each.  With p features that is p * p numbers a model, whatever
the number of rows; p is bounded by ``MAX_FEATURES``.  The optimum is that of the penalty
|w|^2 / 2 + C * (weighted sum of log losses), intercept not penalised.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from callcast.learn.design import BLOCK_FILES, Design, Fit, Learnt, dealt, features, filled, opened, rows_of, summed, unpack
from callcast.session import materialize

MAX_FEATURES = 4096


def dense(num: np.ndarray, codes: np.ndarray, s: Learnt) -> np.ndarray:
    """1, robustly scaled numbers, one column per level."""
    parts = [np.ones((len(num), 1)), (num - s.median) / s.scale]
    parts += [(codes[:, j][:, None] == np.arange(len(known))).astype(float) for j, known in enumerate(s.known)]
    return np.concatenate(parts, axis=1)


@dataclass(frozen=True)
class Unwritten:
    """Features of ``dense`` that a task makes from a block when it needs them, one training set after the other.

    Written, they would hold every level of every column as a number, for every training set; the blocks hold a row once.
    """

    design: Design
    fits: Sequence[Fit]
    learnt: Sequence[Learnt]
    blocks: DataFrame


def unwritten(design: Design, fits: Sequence[Fit], learnt: Sequence[Learnt]) -> Unwritten:
    small = design.blocks.rdd.getNumPartitions() < design.blocks.sparkSession.sparkContext.defaultParallelism
    return Unwritten(design, fits, learnt, materialize(dealt(design.blocks, design.blocks), "design-dealt", **BLOCK_FILES) if small else design.blocks)


def _source(rows: DataFrame | Unwritten):
    """The table that a job reads, and how a task gets (training set, ids, labels, features) out of its batches: of the rows that the wanted training sets learn from, or score."""
    if not isinstance(rows, Unwritten):

        def written(batches, wanted: set, scoring: bool) -> Iterator[tuple]:
            for row in rows_of(batches):
                if row["fit"] in wanted:
                    ids, y, train, score, x = opened(row, np.float64)
                    use = score if scoring else train
                    yield row["fit"], ids[use], y[use], x[use]

        return rows, written
    light = Design(None, rows.design.numeric, rows.design.categorical, rows.design.levels, rows.design.folds)
    sent = rows.blocks.sparkSession.sparkContext.broadcast((light, list(rows.fits), list(rows.learnt)))

    def made(batches, wanted: set, scoring: bool) -> Iterator[tuple]:
        d, sets, stats = sent.value
        for row in rows_of(batches):
            ids, y, num, cat, folds = unpack(row, d)
            for k in sorted(wanted):
                use = sets[k].scores(folds) if scoring else sets[k].trains(folds)
                if use.any():
                    yield k, ids[use], y[use], dense(*filled(num[use], cat[use], stats[k]), stats[k])

    return rows.blocks, made


def fit_logistic(rows: DataFrame | Unwritten, learnt: Sequence[Learnt], strengths: Sequence[float], balanced: bool = True, rounds: int = 50, tol: float = 1e-8) -> dict[tuple[int, int], np.ndarray]:
    """(training set, number of the strength) -> coefficients, intercept first; ``rows`` are features of ``dense``, written or not."""
    p = 1 + len(learnt[0].median) + sum(len(k) for k in learnt[0].known)
    if p > MAX_FEATURES:
        raise ValueError(f"more than MAX_FEATURES={MAX_FEATURES} features")
    keys = [(f, c) for f in range(len(learnt)) for c in range(len(strengths))]
    coef = {k: np.zeros(p) for k in keys}
    best = {k: (np.inf, coef[k]) for k in keys}
    step = {k: np.zeros(p) for k in keys}
    open_keys = set(keys)
    weights = [s.weights if balanced else np.ones(2) for s in learnt]
    penalty = np.ones(p)
    penalty[0] = 0.0
    table, read = _source(rows)
    for _ in range(rounds):
        if not open_keys:
            break
        sent = table.sparkSession.sparkContext.broadcast(({k: coef[k] for k in open_keys}, weights))

        def work(batches):
            state, w = sent.value
            out: dict[int, np.ndarray] = {}
            for fit, _, y, x in read(batches, {f for f, _ in state}, False):
                cw = np.where(y > 0, w[fit][1], w[fit][0])
                for c in (c for f, c in state if f == fit):
                    eta = x @ state[(fit, c)]
                    q = 1 / (1 + np.exp(-np.clip(eta, -500, 500)))
                    loss = (cw * (np.logaddexp(0, eta) - y * eta)).sum()
                    g = x.T @ (cw * (q - y))
                    xs = x * np.sqrt(cw * q * (1 - q))[:, None]
                    h = xs.T @ xs  # symmetric: half the work
                    part = np.concatenate([[loss], g, h.ravel()])
                    key = fit * len(strengths) + c
                    out[key] = out[key] + part if key in out else part
            return out

        got = summed(table, work, len(open_keys) * (p * p + p + 1) * 8)
        sent.unpersist()
        for f, c in sorted(open_keys):
            if f * len(strengths) + c not in got:  # a training set without rows
                open_keys.discard((f, c))
                continue
            data, strength, w = got[f * len(strengths) + c], strengths[c], coef[(f, c)]
            value = strength * data[0] + 0.5 * (penalty * w * w).sum()
            if value > best[(f, c)][0] + 1e-12 * abs(value):  # too far: half of the last step
                step[(f, c)] = step[(f, c)] / 2
                coef[(f, c)] = best[(f, c)][1] + step[(f, c)]
                if np.abs(step[(f, c)]).max() < tol:
                    coef[(f, c)] = best[(f, c)][1]
                    open_keys.discard((f, c))
                continue
            best[(f, c)] = (value, w)
            g = strength * data[1 : p + 1] + penalty * w
            h = strength * data[p + 1 :].reshape(p, p) + np.diag(penalty + 1e-12)
            step[(f, c)] = -np.linalg.lstsq(h, g, rcond=None)[0]
            coef[(f, c)] = w + step[(f, c)]
            if np.abs(step[(f, c)]).max() < tol:
                open_keys.discard((f, c))
    return coef


def score_logistic(rows: DataFrame | Unwritten, coef: dict[tuple[int, int], np.ndarray], n_strengths: int) -> DataFrame:
    """(fit, candidate, id, label, p) for the rows that each training set scores."""
    table, read = _source(rows)
    sent = table.sparkSession.sparkContext.broadcast(coef)

    def run(batches):
        for fit, ids, y, x in read(batches, {f for f, _ in sent.value}, True):
            n = len(ids)
            for c in range(n_strengths) if n else ():
                if (fit, c) in sent.value:
                    p = 1 / (1 + np.exp(-np.clip(x @ sent.value[(fit, c)], -500, 500)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, fit), pa.int32()), pa.array(np.full(n, c), pa.int32()), pa.array(ids), pa.array(y), pa.array(p)], names=["fit", "candidate", "id", "label", "p"])

    return table.mapInArrow(run, "fit int, candidate int, id long, label double, p double")


def logistic_features(design: Design, fits: Sequence[Fit], learnt: Sequence[Learnt], only_scored: bool = False) -> DataFrame:
    return features(design, fits, learnt, dense, "fold-features", only_scored)
