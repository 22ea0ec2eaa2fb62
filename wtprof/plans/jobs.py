"""End-to-end train and predict jobs built from the operators.

Train: sessions (C1, C3, D2) → column roles and null fill (C11, I14, saved with
the version) → held-out split (K3) → TF-IDF fit (J7) →
vectors (J13) → rows for the classifiers (E2, K1) → tree (L1, L2, L3),
specialists (K6, L4, L11), outlier model (L5) + threshold (D11) → metrics
and history on the held-out rows (D7, D8, D10). Artifacts are saved under
``<base>/<name>/version=<v>`` (A9) and ``<base>/models/<v>/…``.

Predict: newest version ≤ as_of (A10) → sessions → the saved roles and fills
(a column of another type fails by name; drift is returned as data) → TF-IDF
transform with the saved vocabulary (J8) → tree → specialists routed by class (L6) →
confirmation (L7) → fusion (L8) → anomaly (L9) → result layout (L10) →
dedupe (F2) → thin NORMAL (K5) → explanations of confirmed attacks by what
the tree's splits and the specialist's coefficients add up to (M1-M3).
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.ml.classification import DecisionTreeClassificationModel, LogisticRegressionModel
from pyspark.ml.feature import PCAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wtprof.operators import attribution as M
from wtprof.operators import explain as X
from wtprof.operators import fusion as L
from wtprof.operators import metrics as D
from wtprof.operators import models as ML
from wtprof.operators import roles as R
from wtprof.operators import sampling as K
from wtprof.operators import specialists as SP
from wtprof.operators import vectorize as V
from wtprof.operators.aggregates import boxplot_threshold
from wtprof.operators.filters import predict_filter, time_range
from wtprof.operators.scaling import scale_fit, scale_transform
from wtprof.operators.sessions import session_text_labeled, status_class_counts
from wtprof.operators.topk import limit_by_threshold
from wtprof.session import materialize
from wtprof.sources import io as A
from wtprof.streaming.sessions import stream_predict

KEY = ["lgtime", "src_ip", "dst_ip", "label"]
TEXT = ["agent", "query"]


@dataclass
class TrainConfig:
    """Everything is fitted on all training rows. Only a caller who sets
    ``fit_rows`` bounds the rows of a class that the tree and specialist fits
    read (those of smallest key hash). ``class_ranges`` gives classes a time
    range of their own."""

    start: str
    end: str
    interval: str = "1 minute"
    fit_rows: int | None = None
    max_features: int = 256
    max_depth: int = 10
    spec_iter: int = 50
    pca_k: int = 8
    model_id: int = 335
    fit_on: str = "train"  # "balanced": fit TF-IDF after oversampling, as the reference did
    numeric: bool = False  # append min-max scaled status counts (D9 ⋈ sessions) to the vector
    class_ranges: dict | None = None  # class → (start, end); other classes: start, end


NUMERIC = ["dst_port_cnt", "info_st", "succ_st", "redir_st", "cler_st", "serer_st", "oth_st"]


def _with_numeric(s: DataFrame, log: DataFrame, interval: str) -> DataFrame:
    """G1: sessions ⋈ per-session status counts (D9) on (bucket, src, dst)."""
    st = status_class_counts(log, interval)
    return s.join(st, ["lgtime", "src_ip", "dst_ip"], "left").fillna(0, subset=NUMERIC)


def _numeric_entries(sessions: DataFrame, scaler: DataFrame, first: int) -> DataFrame:
    """Scaled numeric columns as entries (key, fidx, value) after the text features."""
    num = scale_transform(sessions.select(*KEY, *NUMERIC), scaler, NUMERIC, "minmax")
    cells = F.array(*[F.struct(F.lit(first + i).alias("fidx"), F.col(c).cast("double").alias("value")) for i, c in enumerate(NUMERIC)])
    return num.select(*KEY, F.explode(cells).alias("c")).select(*KEY, "c.fidx", "c.value").where("value <> 0")


def _names(spark: SparkSession, vocab: DataFrame, numeric: bool) -> tuple[DataFrame, int]:
    """(fidx, feature_term) of all features (agent terms, query terms, numeric
    columns) and the number of the text features."""
    names = _feature_index(vocab, vocab).select("fidx", F.concat_ws("_", "feature", "term").alias("feature_term"))
    n = names.count()
    if numeric:
        names = names.unionByName(spark.createDataFrame([(n + i, c) for i, c in enumerate(NUMERIC)], "fidx int, feature_term string"))
    return names, n


def _entries(long: DataFrame, sessions: DataFrame, n_text: int, scaler: DataFrame | None) -> DataFrame:
    """The non-zero features (key, fidx, value) of the sessions."""
    text = long.select(*KEY, "fidx", "value")
    return text if scaler is None else text.unionByName(_numeric_entries(sessions, scaler, n_text))


def _feature_index(long: DataFrame, vocab: DataFrame) -> DataFrame:
    """Global feature position ``fidx``: agent terms, then query terms."""
    n_agent = vocab.where(F.col("feature") == TEXT[0]).select(F.count(F.lit(1))).scalar()
    off = F.when(F.col("feature") == TEXT[1], n_agent).otherwise(F.lit(0))
    return long.withColumn("fidx", (F.col("idx") + off).cast("int"))


def _cells(found: DataFrame, vocab: DataFrame) -> DataFrame:
    """The entries (fidx, value) of all text columns in ``cells``, by feature position."""
    n_agent = vocab.where(F.col("feature") == TEXT[0]).count()
    part = lambda c, off: F.transform(c, lambda x: F.struct((x["idx"] + off).cast("int").alias("fidx"), x["value"].alias("value")))
    return found.select(*KEY, F.concat(part(TEXT[0], 0), part(TEXT[1], n_agent)).alias("cells"))


def _training_log(log: DataFrame, cfg: TrainConfig) -> DataFrame:
    """C1/C3 with a time range of its own for the classes that have one."""
    rows = predict_filter(log)
    if not cfg.class_ranges:
        return time_range(rows, cfg.start, cfg.end)
    # one scan, one predicate; a class without a range of its own, or none, has the common one
    label, time = F.col("hash"), F.col("logtime")
    within = lambda start, end: (time >= F.lit(start)) & (time < F.lit(end))
    keep = within(cfg.start, cfg.end) & (~label.isin(list(cfg.class_ranges)) | label.isNull())
    for cls, (start, end) in cfg.class_ranges.items():
        keep = keep | ((label == cls) & within(start, end))
    return rows.where(keep)


def _fit_specialists(balanced: DataFrame, attacks: list[str], n: int, cfg: TrainConfig) -> tuple[dict, DataFrame]:
    """One pass a step for all attacks, with early stop; attack by
    attack only where the vectors are too wide for a Gram matrix."""
    if n <= SP.MAX_FEATURES:
        return SP.fit_specialists_together(balanced, attacks, max_iter=cfg.spec_iter)
    spec = ML.fit_specialists(K.class_vs_normal(balanced, "label", attacks), attacks, max_iter=cfg.spec_iter)
    return spec, ML.epoch_metrics(spec, cfg.model_id, F.lit(cfg.end).cast("timestamp_ntz"))


def train_job(spark: SparkSession, log: DataFrame, cfg: TrainConfig, base: str, version: str,
              sinks: dict | None = None) -> dict:
    """Train (see module doc). ``sinks`` may name folders or tables for
    ``nodes``, ``importance``, ``epochs`` and ``history`` (A6 appends)."""
    part = _training_log(log, cfg)
    s = session_text_labeled(part, cfg.interval)
    if cfg.numeric:
        s = _with_numeric(s, part, cfg.interval)
    s = materialize(s)
    roles = materialize(R.fit_roles(s, KEY[:3], "label"))
    A.save_fit(roles, base, "roles", version)
    s = K.split_fraction(R.apply_roles(s, roles), KEY, 0.7)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    if cfg.fit_on == "balanced":
        vocab = V.tfidf_fit(K.oversample_to_max(train, "label", KEY[:3]), [*KEY, "copy"], TEXT, cfg.max_features, unique=True)
    else:
        vocab = V.tfidf_fit(train, KEY, TEXT, cfg.max_features, unique=True)
    vocab = materialize(vocab)
    A.save_fit(vocab, base, "tfidf", version)
    names, n_text = _names(spark, vocab, cfg.numeric)
    scaler = None
    if cfg.numeric:
        scaler = scale_fit(train, NUMERIC, "minmax")
        A.save_fit(scaler, base, "scaler", version)
    n = n_text + (len(NUMERIC) if cfg.numeric else 0)

    def vectors(sessions: DataFrame) -> DataFrame:  # a row of the session aggregate is a session
        if scaler is None and n <= V.ROW_VOCABULARY:
            return V.assemble(_cells(V.tfidf_cells(sessions, vocab, KEY, TEXT), vocab), KEY, n, index_col="fidx", cells="cells")
        long = _feature_index(V.tfidf_transform(sessions, vocab, KEY, TEXT, unique=True), vocab)
        return V.assemble(_entries(long, sessions, n_text, scaler), KEY, n, index_col="fidx", rows=sessions.select(*KEY))

    rows_tr = vectors(train)
    fitted = rows_tr.dropna(subset=KEY)  # a null in the key: no vector to fit on, see assemble
    if cfg.fit_rows is not None:
        by_hash = train.withColumn("_h", F.xxhash64(*KEY))
        chosen = limit_by_threshold(by_hash, cfg.fit_rows, "label", ["_h", *KEY[:3]])
        fitted = fitted.join(chosen.select(*KEY), KEY, "left_semi")
    balanced = materialize(K.oversample_to_max(fitted, "label", KEY).drop("copy"))
    tree, labels = ML.fit_tree_on_all_rows(balanced, max_depth=cfg.max_depth)
    mdir = os.path.join(base, "models", version)
    tree.write().overwrite().save(os.path.join(mdir, "tree"))
    A.save_fit(spark.createDataFrame([(x,) for x in labels], "label string"), base, "labels", version)
    attacks = [x for x in labels if x != "normal"]
    spec, epochs = _fit_specialists(balanced, attacks, n, cfg)
    for a, m in spec.items():
        m.write().overwrite().save(os.path.join(mdir, f"spec_{a}"))
    # what belongs to this version is data, read back with it (no probing of folders)
    A.save_fit(spark.createDataFrame([(x,) for x in spec], "label string"), base, "specialists", version)
    A.save_fit(spark.createDataFrame([(cfg.numeric,)], "numeric boolean"), base, "settings", version)
    pca = ML.fit_outlier(rows_tr.where(F.col("label") == "normal"), k=min(cfg.pca_k, n))
    pca.write().overwrite().save(os.path.join(mdir, "pca"))
    normal_scores = ML.outlier_score(pca, rows_tr.where(F.col("label") == "normal"))
    thr = materialize(boxplot_threshold(normal_scores, "normal", "box"))
    A.save_fit(thr, base, "threshold", version)
    # held-out evaluation
    rows_te = vectors(test)
    pred = materialize(ML.predict_tree(tree, labels, rows_te).select(*KEY, "pred"))
    metrics = D.binary_metrics(pred, "label", "pred")
    logtime = F.lit(cfg.end).cast("timestamp_ntz")  # the run's own time, not the clock
    epochs = epochs.select(F.lit(cfg.model_id).alias("model_id"), "attack_name", logtime.alias("logtime"), "epochs", "loss", "accuracy")
    history = D.run_history(epochs, metrics)
    nodes = ML.tree_nodes(tree, labels, names, os.path.join(mdir, "tree_nodes_model"), cfg.model_id, version, cfg.end)
    day = dt.datetime.fromisoformat(cfg.end)
    importance = ML.tree_importance(tree, names, cfg.model_id, cfg.end, day.weekday(), f"{day.hour:02d}")
    out = dict(vocab=vocab, names=names, labels=labels, tree=tree, spec=spec, pca=pca, threshold=thr,
               metrics=metrics, weighted=D.weighted_metrics(pred, "label", "pred"), epochs=epochs, history=history,
               nodes=nodes, importance=importance, confusion=D.confusion_matrix(pred, "label", "pred"))
    for name, target in (sinks or {}).items():
        A.append_results(out[name], target)
    return out


@dataclass
class Artifacts:
    """Everything of one model version that scoring needs."""

    version: str
    vocab: DataFrame
    labels: list
    threshold: float
    tree: object
    spec: dict
    pca: object
    paths: DataFrame         # what each split on the way to a leaf adds to each class
    base: DataFrame          # the classes' probabilities at the root
    coefficients: DataFrame
    scaler: DataFrame | None
    roles: DataFrame         # the columns, their roles and fill values when trained


class Scored(NamedTuple):
    """Scored sessions and what explains them."""

    fused: DataFrame
    long: DataFrame      # TF-IDF entries with terms
    entries: DataFrame   # all non-zero features (key, fidx, value)
    rows: DataFrame      # key and feature vector
    names: DataFrame     # (fidx, feature_term)
    n: int


def newest_version(spark: SparkSession, base: str, as_of: str | None = None) -> str:
    """Newest complete version, at or before ``as_of`` if given (A10)."""
    versions = spark.read.parquet(os.path.join(base, "threshold")).select("version").distinct()  # saved last
    found = (versions.agg(F.max("version")) if as_of is None else A.latest_version(versions, as_of)).first()[0]  # one string
    if found is None:
        raise ValueError(f"no model version at or before {as_of}")
    return found


def load_artifacts(spark: SparkSession, base: str, as_of: str | None = None, version: str | None = None) -> Artifacts:
    """The parts of ``version``, or of the newest version at or before
    ``as_of``. What a version consists of is read from its saved lists; a
    listed part that is missing fails."""
    version = version or newest_version(spark, base, as_of)
    load = lambda name: A.load_fit(spark, base, name, version)
    names = lambda name: [r[0] for r in load(name).orderBy("label").collect()]  # noqa: E731  a row for each class
    mdir = os.path.join(base, "models", version)
    labels = names("labels")
    spec = {a: LogisticRegressionModel.load(os.path.join(mdir, f"spec_{a}")) for a in names("specialists")}
    paths, root = M.tree_paths(spark, os.path.join(mdir, "tree"), labels)
    return Artifacts(
        version, materialize(load("tfidf")), labels, load("threshold").select("threshold").first()[0],
        DecisionTreeClassificationModel.load(os.path.join(mdir, "tree")), spec, PCAModel.load(os.path.join(mdir, "pca")),
        materialize(paths), materialize(root), M.coefficients(spark, spec),
        load("scaler") if load("settings").first()["numeric"] else None, load("roles").drop("version"))


def score_sessions(art: Artifacts, s: DataFrame, interval: str, part: DataFrame | None = None, unique: bool = False) -> Scored:
    """Tree, specialists, confirmation (L7), fusion (L8) and anomaly (L9) of
    sessions. A model with numeric features needs the log rows ``part``, too.
    ``unique``: the sessions have one row each."""
    if art.scaler is not None:
        if part is None:
            raise ValueError("this model version has numeric features: scoring needs the log rows")
        s = _with_numeric(s, part, interval)
    s = R.apply_roles(s, art.roles)
    long = _feature_index(V.tfidf_transform(s, art.vocab, KEY, TEXT, unique=unique), art.vocab)
    names, n_text = _names(s.sparkSession, art.vocab, art.scaler is not None)
    entries = _entries(long, s, n_text, art.scaler)
    n = n_text + (len(NUMERIC) if art.scaler is not None else 0)
    if unique and art.scaler is None and n <= V.ROW_VOCABULARY:
        rows = V.assemble(_cells(V.tfidf_cells(s, art.vocab, KEY, TEXT), art.vocab), KEY, n, index_col="fidx", cells="cells")
    else:
        rows = V.assemble(entries, KEY, n, index_col="fidx", rows=s.select(*KEY))
    scored = ML.outlier_score(art.pca, ML.predict_specialists(art.spec, ML.predict_tree(art.tree, art.labels, rows)))
    for a in art.labels:
        if a not in scored.columns:
            scored = scored.withColumn(a, F.lit(0.0))  # a class without a specialist
    routed = L.route_by_class(scored, "pred", art.labels)
    attacks = [a for a in art.labels if a != "normal"]
    own = F.greatest(*[F.col(a) for a in attacks], F.lit(0.0)) if attacks else F.lit(0.0)
    routed = L.confirm_attack(routed.withColumn("_own", own), "pred", "_own").drop("_own")
    fused = L.apply_anomaly(L.fuse_scores(routed, art.labels), art.threshold)
    fused = fused.withColumn("end", F.col("lgtime") + F.expr(f"INTERVAL '{interval}'"))
    return Scored(fused.drop("features"), long, entries, rows, names, n)


def predict_job(spark: SparkSession, log: DataFrame, base: str, as_of: str, start: str, end: str,
                interval: str = "1 minute", model_id: int = 250, explain_top: int | None = None,
                sinks: dict | None = None) -> dict:
    """Predict (see module doc). ``sinks`` may name folders or tables for
    ``result`` (A6 append), ``explain`` and ``features`` (A7 appends in
    files of ≤ 200 000 rows): results, explanations of the attacks that were
    confirmed (full rankings unless ``explain_top`` cuts them), and the
    non-NORMAL sessions' feature lists."""
    art = load_artifacts(spark, base, as_of)
    part = predict_filter(time_range(log, start, end))
    s = materialize(session_text_labeled(part, interval))
    sc = score_sessions(art, s, interval, part, unique=True)
    drift = R.role_drift(_with_numeric(s, part, interval) if art.scaler is not None else s, art.roles, KEY[:3], "label")
    fused = materialize(sc.fused)
    result = L.result_record(fused, model_id, art.version).dropDuplicates()
    thinned = K.thin_class(result, "att_name", "NORMAL", 1, key=["lgtime", "src_ip", "dst_ip"])
    # explanations: what the tree and the confirming specialist add up to
    confirmed = fused.where(F.col("ai_label_pred") != "NORMAL").select(*KEY, F.col("ai_label_pred").alias("prediction"))
    explained = M.model_score(sc.rows.join(confirmed, KEY), art.tree, art.labels, art.base, art.spec)
    contrib = M.model_contribution(sc.entries, explained, art.paths, art.coefficients, KEY)
    expl = X.explain_confirmed(X.explain_rows(contrib, sc.names, KEY, sc.n, version=art.version, top_k=explain_top, rows=confirmed),
                               [x for x in art.labels if x != "normal"])
    feats = _feature_lists(fused, sc.long, s, part, interval, model_id, art.version)
    if sinks:
        if "result" in sinks:
            A.append_results(thinned, sinks["result"])
        if "drift" in sinks:
            A.append_results(drift, sinks["drift"])
        if "explain" in sinks:
            A.append_batched(expl, sinks["explain"])
        if "features" in sinks:
            A.append_batched(feats, sinks["features"])
    return dict(version=art.version, result=thinned, explanations=expl, fused=fused, features=feats, drift=drift)


def _feature_lists(fused: DataFrame, long: DataFrame, s: DataFrame, part: DataFrame, interval: str, model_id: int,
                   version: str) -> DataFrame:
    """Feature lists of the non-NORMAL sessions: for each text column the
    terms and their values (by term), and the status and port counts."""
    cells = F.struct("term", "value")
    per = long.groupBy(*KEY).agg(*[F.sort_array(F.collect_list(F.when(F.col("feature") == c, cells))).alias(f"_{c}") for c in TEXT])
    hit = fused.where(F.col("att_name") != "NORMAL").select(*KEY, "end", "att_name", "result", "probs", "anomaly_score")
    empty = F.array().cast("array<struct<term:string,value:double>>")
    rows = _with_numeric(hit.join(per, KEY, "left"), part, interval)
    lists = []
    for c in TEXT:
        e = F.coalesce(f"_{c}", empty)
        lists += [F.transform(e, lambda x: x["term"]).alias(f"{c}_feature"), F.transform(e, lambda x: x["value"]).alias(f"{c}_value")]
    return rows.select(F.lit(model_id).alias("model_id"), F.lit(version).alias("model_ver"), *KEY, "end", "att_name", "result",
                       "probs", "anomaly_score", *lists, *NUMERIC)


def stream_predict_job(spark: SparkSession, sessions: DataFrame, base: str, as_of: str | None, interval: str, sink: str,
                       checkpoint: str, model_id: int = 250) -> None:
    """Closed sessions of a stream, scored per micro-batch into result
    records with the newest model version there is when the batch starts (at
    or before ``as_of``, if given).

    The version is written down with the batch's number before the batch is
    scored (``<checkpoint>_versions``), and a batch that is replayed uses the
    version written down. Artifacts are loaded once a version."""
    record = f"{checkpoint.rstrip('/')}_versions"
    schema = "batch bigint, version string"
    spark.createDataFrame([], schema).write.mode("append").parquet(record)
    loaded: dict[str, Artifacts] = {}

    def score(batch: DataFrame, batch_id: int) -> DataFrame:
        known = spark.read.schema(schema).parquet(record).where(F.col("batch") == batch_id).agg(F.min("version")).first()[0]
        if known is None:
            known = newest_version(spark, base, as_of)
            spark.createDataFrame([(batch_id, known)], schema).coalesce(1).write.mode("append").parquet(record)
        if known not in loaded:
            loaded.clear()
            loaded[known] = load_artifacts(spark, base, version=known)
        return L.result_record(score_sessions(loaded[known], batch, interval).fused, model_id, known)

    stream_predict(sessions, score, sink, checkpoint)
