"""All specialists fitted in one pass a step (L4), with early stop.

A specialist is a logistic regression of one attack against normal. Fitted one
by one, each needs its own passes over the normal rows. Here one scan of the
rows sums, for every attack at once, the log loss, the hits, the gradient and
the Gram matrix Σ p(1−p) x xᵀ at its present coefficients; the sums of the
partitions are added by attack in two levels, and the driver solves one small
system for each attack (a Newton step, damped where the loss rose). The
objective is that of ``pyspark.ml``'s LogisticRegression with standardisation:
mean log loss plus reg/2 · Σ (σⱼ βⱼ)², σ being the sample deviation, a constant
feature having no coefficient.

An epoch is one scan, so loss and accuracy of every epoch are known. A fit ends
when its gradient vanishes, after ``max_iter`` epochs, or by the stop rule: no
loss below the best one less ``min_delta`` for ``patience`` epochs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wtprof.session import materialize

PATIENCE, MIN_DELTA = 10, 0.001
MAX_FEATURES = 2500     # the Gram matrix of an attack stays below 50 MB
FAN = 32                # partial sums added in a first level
STEP_ROWS = 4096
BLOCK_BYTES = 8192      # of the sparse rows in a block; a batch of blocks stays in the tens of MB
BLOCK_COLUMNS = ["codes", "lengths", "indices", "vals"]


class _State:
    """One attack's fit between two scans."""

    def __init__(self, size: int):
        self.beta, self.tried = np.zeros(size + 1), np.zeros(size + 1)  # intercept last
        self.loss, self.damping = np.inf, 0.0
        self.gradient = self.gram = self.deviation = None
        self.epochs: list[tuple[float, float]] = []
        self.best, self.wait, self.done = np.inf, 0, False

    def take(self, s: np.ndarray, size: int, reg: float, tol: float, patience: int, min_delta: float) -> None:
        """The sums of a scan at ``tried``: accept it or damp, then try the next step."""
        n, loss, hits = s[0], s[1] / s[0], s[2] / s[0]
        if self.deviation is None:
            sums, squares = s[3:3 + size], s[3 + size:3 + 2 * size]
            spread = (squares - sums * sums / n) / max(1.0, n - 1)
            scale = np.maximum(squares / n, 1e-300)
            self.deviation = np.sqrt(np.where(spread > 1e-14 * scale, spread, 0.0))
        rest = s[3 + 2 * size:]
        ridge = np.append(reg * self.deviation ** 2, 0.0)
        loss += 0.5 * float(ridge @ self.tried ** 2)
        self.epochs.append((loss, hits))
        if loss <= self.loss:
            self.loss, self.beta = loss, self.tried
            self.gradient = rest[:size + 1] / n + ridge * self.beta
            self.gram = rest[size + 1:].reshape(size + 1, size + 1) / n + np.diag(ridge)
            self.damping /= 10
        else:
            self.damping = max(self.damping * 10, 1e-6 * float(np.trace(self.gram)) / (size + 1))
        used = np.append(self.deviation > 0, True)
        if loss < self.best - min_delta:
            self.best, self.wait = loss, 0
        else:
            self.wait += 1
        self.done = bool(self.wait >= patience or np.abs(self.gradient[used]).max() <= tol)
        least = 1e-12 * float(np.trace(self.gram)) / (size + 1)
        system = self.gram[np.ix_(used, used)] + (self.damping + least) * np.eye(int(used.sum()))
        step = np.zeros(size + 1)
        step[used] = np.linalg.solve(system, self.gradient[used])
        self.tried = self.beta - step


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (code, i, v) as blocks of about ``BLOCK_BYTES``: codes, lengths,
    indices and values of many sparse rows, each as one binary value."""
    for batch in batches:
        if not batch.num_rows:
            continue
        if batch.column("v").null_count:
            raise ValueError("a row without features")
        code = batch.column("code").to_numpy(zero_copy_only=False).astype(np.int32)
        length = batch.column("v").value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
        index = batch.column("i").flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        value = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends = np.cumsum(length, dtype=np.int64)
        block = (ends * 12 + np.arange(len(code)) * 8) // BLOCK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(code)]
        entry = np.append(0, ends)
        rows = [(code[a:b].tobytes(), length[a:b].tobytes(), index[entry[a]:entry[b]].tobytes(), value[entry[a]:entry[b]].tobytes())
                for a, b in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows)], BLOCK_COLUMNS)


def _partial(attacks: list[str], size: int, shared):
    """Sums of one partition, a row for each attack still being fitted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        betas, open_ = shared.value
        total = {a: np.zeros(3 + 2 * size + (size + 1) + (size + 1) ** 2) for a in open_}
        for batch in batches:
            code, length, index, value = (np.frombuffer(b"".join(batch.column(c).to_pylist()), t)
                                          for c, t in zip(BLOCK_COLUMNS, (np.int32, np.int32, np.int32, np.float64)))
            entry = np.append(0, np.cumsum(length, dtype=np.int64))
            for k in range(0, len(code), STEP_ROWS):
                here, n = code[k:k + STEP_ROWS], length[k:k + STEP_ROWS]
                cells = slice(entry[k], entry[k + len(here)])
                x = np.zeros((len(here), size + 1))
                x[np.repeat(np.arange(len(here)), n), index[cells]] = value[cells]
                x[:, size] = 1.0
                normal = x[here == 0]
                for a in open_:
                    for one, t in ((normal, 0.0), (x[here == attacks.index(a) + 1], 1.0)):
                        if not len(one):
                            continue
                        z = one @ betas[a]
                        p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                        s, m = total[a], one[:, :size]
                        s[0] += len(one)
                        s[1] += (np.logaddexp(0, z) - t * z).sum()
                        s[2] += ((p > 0.5) == (t > 0.5)).sum()
                        s[3:3 + size] += m.sum(0)
                        s[3 + size:3 + 2 * size] += np.einsum("ij,ij->j", m, m)
                        s[3 + 2 * size:4 + 3 * size] += one.T @ (p - t)
                        s[4 + 3 * size:] += (one.T @ (one * (p * (1 - p))[:, None])).ravel()
        part = TaskContext.get().partitionId() % FAN
        keep = [a for a in open_ if total[a][0]]
        yield pa.RecordBatch.from_arrays([pa.array(keep, pa.string()), pa.array([part] * len(keep), pa.int32()),
                                          pa.array([total[a].tobytes() for a in keep], pa.binary())], ["attack", "part", "sums"])
    return run


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b, np.float64) for b in table.column("sums").to_pylist())
    return pa.table({"attack": [table.column("attack")[0].as_py()], "part": pa.array([0], pa.int32()),
                     "sums": pa.array([total.tobytes()], pa.binary())})


def _model(spark: SparkSession, beta: np.ndarray, features_col: str) -> LogisticRegressionModel:
    """The coefficients as an ordinary Spark ML model, to be saved and applied like any other."""
    sc = spark.sparkContext
    java = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"specialist_{uuid.uuid4().hex[:12]}", _py2java(sc, Vectors.dense(beta[:-1])), float(beta[-1]))
    return LogisticRegressionModel(java).setFeaturesCol(features_col)


def fit_specialists_together(rows: DataFrame, attacks: Sequence[str], features_col: str = "features", label_col: str = "label",
                             normal: str = "normal", max_iter: int = 50, reg: float = 0.0, tol: float = 1e-9,
                             patience: int = PATIENCE, min_delta: float = MIN_DELTA) -> tuple[dict, DataFrame]:
    """L4 + L11: ``({attack: model}, epochs)``; epochs is ``(attack_name,
    epochs, loss, accuracy)``, one row for each attack and scan.

    ``rows`` carry a class and a feature vector each (of at most
    ``MAX_FEATURES`` entries); rows of other classes are not read, and an
    attack without rows gets no model. One job a step, however many attacks
    there are. The rows are written once as blocks of sparse rows, which
    every step scans: a scan neither decodes nor converts single rows."""
    spark = rows.sparkSession
    mine = rows.where(F.col(label_col).isin([*attacks, normal])).select(F.col(label_col).alias("label"), F.col(features_col).alias("x"))
    first = mine.select(F.size(vector_to_array("x"))).first()
    size = first[0] if first else 0
    if size > MAX_FEATURES:
        raise ValueError(f"{size} features: the one-pass fit takes {MAX_FEATURES}; fit class by class")
    # the scan only counts classes that occur
    present = {r[0] for r in mine.select("label").distinct().collect()} if first else set()
    state = {a: _State(size) for a in attacks if a in present}
    names = list(state)
    if names:
        raw = mine.select("label", F.unwrap_udt("x").alias("u"))
        every = F.when(F.size("u.values") > 0, F.sequence(F.lit(0), F.size("u.values") - 1)).otherwise(F.array().cast("array<int>"))
        code = F.when(F.col("label") == normal, 0).otherwise(F.array_position(F.array(*map(F.lit, names)), F.col("label"))).cast("int")
        raw = raw.select(code.alias("code"), F.when(F.col("u.type") == 1, every).otherwise(F.col("u.indices")).alias("i"), F.col("u.values").alias("v"))
        blocks = materialize(raw.mapInArrow(_packed, ", ".join(f"{c} binary" for c in BLOCK_COLUMNS)))
    for _ in range(max_iter):
        open_ = [a for a, s in state.items() if not s.done]
        if not open_:
            break
        shared = spark.sparkContext.broadcast(({a: state[a].tried for a in open_}, open_))  # attacks × features
        schema = "attack string, part int, sums binary"
        sums = blocks.mapInArrow(_partial(names, size, shared), schema)
        sums = sums.groupBy("attack", "part").applyInArrow(_added, schema).groupBy("attack").applyInArrow(_added, schema)
        for r in sums.collect():  # a row for each attack
            state[r["attack"]].take(np.frombuffer(r["sums"], np.float64), size, reg, tol, patience, min_delta)
        shared.unpersist()
    history = [(a, k, float(loss), float(hits)) for a, s in state.items() for k, (loss, hits) in enumerate(s.epochs, start=1)]
    epochs = spark.createDataFrame(history, "attack_name string, epochs int, loss double, accuracy double")
    return {a: _model(spark, s.beta, features_col) for a, s in state.items()}, epochs


def early_stop(epochs: DataFrame, group: Sequence[str], epoch_col: str = "epochs", loss_col: str = "loss",
               patience: int = PATIENCE, min_delta: float = MIN_DELTA) -> DataFrame:
    """Where the stop rule ends each group's fit: ``(group…, epochs,
    stop_epoch, best_epoch, best_loss)``.

    An epoch improves if its loss is below the best one less ``min_delta``;
    after ``patience`` epochs without improvement the fit stops. stop_epoch is
    the last epoch if the rule never applies. A null loss doesn't improve.
    The epochs of a group (bounded by the fit) are walked in order."""
    entry = F.struct(F.col(epoch_col).cast("int").alias("e"), F.col(loss_col).cast("double").alias("l"))
    g = epochs.groupBy(*group).agg(F.sort_array(F.collect_list(entry)).alias("_h"))

    def state(best: Column, at: Column, wait: Column, stop: Column) -> Column:
        return F.struct(best.cast("double").alias("best"), at.cast("int").alias("at"), wait.cast("int").alias("wait"),
                        stop.cast("int").alias("stop"))

    def walk(s: Column, x: Column) -> Column:
        better = F.coalesce(x["l"] < s["best"] - min_delta, F.lit(False))
        wait = s["wait"] + 1
        moved = F.when(better, state(x["l"], x["e"], F.lit(0), s["stop"])).otherwise(
            state(s["best"], s["at"], wait, F.when(wait >= patience, x["e"])))
        return F.when(s["stop"].isNotNull(), s).otherwise(moved)

    start = state(F.lit(float("inf")), F.lit(None), F.lit(0), F.lit(None))
    end = g.select(*group, F.size("_h").alias("epochs"), F.element_at("_h", -1)["e"].alias("_last"),
                   F.aggregate("_h", start, walk).alias("_s"))
    best = F.when(F.col("_s.at").isNotNull(), F.col("_s.best"))
    return end.select(*group, "epochs", F.coalesce("_s.stop", "_last").alias("stop_epoch"), F.col("_s.at").alias("best_epoch"),
                      best.alias("best_loss"))
