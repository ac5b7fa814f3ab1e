"""Rankers on Spark MLlib.

The listwise boosted ranker of the original study has no MLlib
counterpart, so the rankers here are:

* pointwise: ``GBTRegressor`` on the relevance grade, early stopping on a
  validation indicator (``validationIndicatorCol``);
* pairwise least squares: every within-search pair at once, through a
  weighted ``LinearRegression`` on per-search centred features (see
  ``operators.pairs``);
* pairwise logistic: the listed pairs of each search's top rows, weighted by
  their part in NDCG, through ``LogisticRegression`` on feature differences;
* one pointwise model per country partition.

Missing feature values: trees and linear models need complete vectors, so
every feature gets a median imputation (``Imputer``, fitted on the training
rows only) plus an ``<col>_isnull`` indicator when it has nulls.  Columns
that are entirely null are left out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchrank.session import ensure_checkpoint_dir, scratch_path

# Columns never used as features (ids, labels, leakage).
NON_FEATURES = ("srch_id", "prop_id", "booking_bool", "click_bool", "gross_bookings_usd",
                "position", "relevance_grade", "orig_destination_distance", "date_time",
                "weight", "supp_id", "part_id", "pred")
# Tuned learner settings of the original study.
REFERENCE_PARAMS = {"eta": 0.13963013806537555, "max_depth": 9,
                    "subsample": 0.7038375178678972, "colsample": 0.7015452447331039,
                    "seed": 42, "rounds": 130}


def feature_columns(df: DataFrame, exclude: Sequence[str] = NON_FEATURES) -> list[str]:
    """Numeric columns minus ids, labels and leakage columns (P5)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in ex and isinstance(f.dataType, T.NumericType)]


def _prep_stages(train: DataFrame, features: Sequence[str]):
    """Decide indicator columns from one null-count aggregate of the training rows."""
    row = train.agg(F.count(F.lit(1)).alias("_n"),
                    *[F.count(F.col(c)).alias(c) for c in features]).collect()[0]
    n = row["_n"]
    usable = [c for c in features if row[c] > 0]          # all-null columns are left out
    flagged = [c for c in usable if row[c] < n]
    return usable, flagged


def _with_flags(df: DataFrame, usable: Sequence[str], flagged: Sequence[str]) -> DataFrame:
    cols = [F.col(c).cast("double").alias(f"_f_{c}") for c in usable]
    cols += [F.col(c).isNull().cast("double").alias(f"{c}_isnull") for c in flagged]
    return df.select("*", *cols)


def _assembler_inputs(usable, flagged):
    return [f"_i_{c}" for c in usable] + [f"{c}_isnull" for c in flagged]


@dataclass
class Ranker:
    model: PipelineModel
    usable: list[str]
    flagged: list[str]
    kind: str

    def score(self, df: DataFrame, out: str = "pred") -> DataFrame:
        """Add ``out`` (higher = better) to every row (M5)."""
        scored = self.model.transform(_with_flags(df, self.usable, self.flagged))
        keep = [c for c in df.columns]
        return scored.select(*keep, F.col("prediction").alias(out))

    def save(self, path: str) -> None:
        """Model and column lists below one folder."""
        self.model.write().overwrite().save(f"{path}/model")
        write_note(path, "columns", json.dumps({"usable": self.usable, "flagged": self.flagged, "kind": self.kind}))

    @classmethod
    def load(cls, path: str) -> Ranker:
        model = PipelineModel.load(f"{path}/model")
        note = json.loads(read_note(SparkSession.getActiveSession(), path, "columns"))
        return cls(model, note["usable"], note["flagged"], note["kind"])

    @property
    def feature_names(self) -> list[str]:
        return list(self.usable) + [f"{c}_isnull" for c in self.flagged]


def write_note(path: str, name: str, text: str) -> None:
    """A small text next to a model, through Spark's writer (any store)."""
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{name}")


def read_note(spark: SparkSession, path: str, name: str) -> str:
    return spark.read.text(f"{path}/{name}").first()["value"]


def reference_settings() -> dict:
    """``fit_ranker`` arguments with the tuned settings of the original study."""
    p = REFERENCE_PARAMS
    return {"max_iter": p["rounds"], "max_depth": p["max_depth"], "step_size": p["eta"],
            "subsample": p["subsample"], "colsample": p["colsample"], "seed": p["seed"]}


def _base_stages(usable, flagged):
    imp = Imputer(strategy="median", inputCols=[f"_f_{c}" for c in usable],
                  outputCols=[f"_i_{c}" for c in usable])
    vec = VectorAssembler(inputCols=_assembler_inputs(usable, flagged), outputCol="features",
                          handleInvalid="keep")
    return [imp, vec]


#: Rounds whose lineage is carried without a checkpoint.  A checkpoint writes the prediction and error of every row.
PLAIN_ROUNDS = 40


def _checkpoints(rounds: int) -> int:
    """``checkpointInterval`` of a boosted fit: every ten rounds, or none (-1) if the rounds are few."""
    return 10 if rounds > PLAIN_ROUNDS else -1


def fit_ranker(train: DataFrame, features: Sequence[str] | None = None,
               label: str = "relevance_grade", valid: DataFrame | None = None,
               max_iter: int = 20, max_depth: int = 5, step_size: float = 0.1,
               subsample: float = 0.7, colsample: float = 0.7, seed: int = 42,
               validation_tol: float = 0.01) -> Ranker:
    """Pointwise GBT ranker (M1).  With ``valid`` the boosting stops early
    when the validation error stops improving (M2)."""
    ensure_checkpoint_dir(train.sparkSession)
    features = list(features or feature_columns(train))
    usable, flagged = _prep_stages(train, features)
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction",
                       maxIter=max_iter, maxDepth=max_depth, stepSize=step_size,
                       subsamplingRate=subsample, featureSubsetStrategy=str(colsample),
                       seed=seed, checkpointInterval=_checkpoints(max_iter), cacheNodeIds=False,
                       validationTol=validation_tol)
    data = _with_flags(train, usable, flagged)
    if valid is not None:
        data = data.withColumn("_is_valid", F.lit(False)).unionByName(
            _with_flags(valid, usable, flagged).withColumn("_is_valid", F.lit(True)))
        gbt.setValidationIndicatorCol("_is_valid")
    model = Pipeline(stages=_base_stages(usable, flagged) + [gbt]).fit(data)
    return Ranker(model, usable, flagged, "gbt")


def fit_pairwise(train: DataFrame, features: Sequence[str] | None = None,
                 label: str = "relevance_grade", by: str = "srch_id",
                 reg: float = 0.01) -> Ranker:
    """Pairwise least-squares ranker over all within-search pairs (M3).

    Loss = sum over searches s, pairs a<b in s of ((w.x_a - w.x_b) - (y_a - y_b))^2
         = sum_s n_s * sum_{a in s} (w.(x_a - mean_s x) - (y_a - mean_s y))^2,
    i.e. a regression without intercept on features and labels centred per
    search, each row weighted by its search size.  Rows are shuffled once, as they
    are, imputed behind that and centred by windows; hot searches stay where they
    are and meet their means by a broadcast of fewer rows than partitions.
    """
    from searchrank.operators import skew
    from searchrank.sources.io import materialize
    ensure_checkpoint_dir(train.sparkSession)
    features = list(features or feature_columns(train))
    usable, flagged = _prep_stages(train, features)
    flagged_train = _with_flags(train, usable, flagged)
    prep = PipelineModel(stages=[s.fit(flagged_train) if hasattr(s, "fit") else s
                                 for s in _base_stages(usable, flagged)[:1]])
    cols = _assembler_inputs(usable, flagged)
    few = train.select(*dict.fromkeys([by, label, *usable])).where(F.col(by).isNotNull())
    plain, hot = skew.cut(few, skew.hot_searches(few, by), by)
    search = Window.partitionBy(by)
    j = prep.transform(_with_flags(plain.repartition(F.col(by)), usable, flagged)).select(
        F.col(label).alias("_l"), *cols, F.count(F.lit(1)).over(search).alias("_n"), F.avg(label).over(search).alias("_ym"),
        *[F.avg(c).over(search).alias(f"_m{i}") for i, c in enumerate(cols)])
    if hot is not None:
        imputed = prep.transform(_with_flags(hot, usable, flagged))
        means = imputed.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), F.avg(label).alias("_ym"),
                                        *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)])
        j = j.unionByName(imputed.join(F.broadcast(means), by).select(F.col(label).alias("_l"), *j.columns[1:]))
    centred = j.select(
        (F.col("_l") - F.col("_ym")).alias("_y"), F.col("_n").cast("double").alias("_w"),
        *[(F.col(c) - F.col(f"_m{i}")).alias(c) for i, c in enumerate(cols)])
    # the regression reads its input more than once (summary, solve): stage it
    centred = materialize(centred, "pairwise-centred", compact=True)
    vec = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")
    lr = LinearRegression(featuresCol="features", labelCol="_y", weightCol="_w",
                          fitIntercept=False, regParam=reg, elasticNetParam=0.0,
                          predictionCol="prediction")
    lr_model = lr.fit(vec.transform(centred))
    model = PipelineModel(stages=list(prep.stages) + [vec, lr_model])
    return Ranker(model, usable, flagged, "pairwise")


def fit_pairs(train: DataFrame, features: Sequence[str] | None = None, label: str = "relevance_grade",
              by: str = "srch_id", score: str | None = None, k: int = 6, reg: float = 0.001,
              weight: str = "ndcg", tiebreak: Sequence[str] = ("prop_id", "position", "supp_id")) -> Ranker:
    """Pairwise logistic ranker on the top-``k`` pairs of each search (M3).

    The top rows are those by ``score``; without it, by the least-squares
    ranker fitted first, as boosting takes them from the model so far.  The pair table
    (``pairs.make_pairs``) is staged once; a row's score is w.x with the weights
    of the logistic fit on feature differences (no intercept).
    """
    from searchrank.operators import pairs
    from searchrank.sources.io import materialize
    ensure_checkpoint_dir(train.sparkSession)
    features = list(features or feature_columns(train))
    first = None
    if score is None:
        first = fit_pairwise(train, features, label, by)
        usable, flagged = first.usable, first.flagged
        prep = PipelineModel(stages=first.model.stages[:1])
    else:
        usable, flagged = _prep_stages(train, features)
        flat = _with_flags(train, usable, flagged)
        prep = PipelineModel(stages=[_base_stages(usable, flagged)[0].fit(flat)])
    cols = _assembler_inputs(usable, flagged)
    ties = [c for c in tiebreak if c in train.columns]
    rows = first.score(train, "_first") if first else train.withColumn("_first", F.col(score))
    rows = prep.transform(_with_flags(rows, usable, flagged)).select(
        *dict.fromkeys([by, label, "_first", *ties]), *[F.col(c).alias(f"x{i}") for i, c in enumerate(cols)])
    rows = materialize(rows, "pair-rows")
    xs = [f"x{i}" for i in range(len(cols))]
    table = materialize(pairs.make_pairs(rows, xs, by, label, "_first", k, ties, weight).where("weight > 0").select(
        "label", "weight", *[f"d_{x}" for x in xs]), "pairs")
    vec = VectorAssembler(inputCols=[f"d_{x}" for x in xs], outputCol="features")
    fit = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", fitIntercept=False,
                             regParam=reg, elasticNetParam=0.0, family="binomial").fit(vec.transform(table))
    w = fit.coefficients.toArray().tolist()   # one number per feature
    terms = " + ".join(f"{v!r}D * `{c}`" for v, c in zip(w, cols))
    score_it = SQLTransformer(statement=f"SELECT *, {terms} AS prediction FROM __THIS__")
    return Ranker(PipelineModel(stages=[*prep.stages, score_it]), usable, flagged, "pairs")


def gbt_stage(r: Ranker) -> GBTRegressionModel:
    return r.model.stages[-1]


def _nodes(r: Ranker) -> tuple[list[dict], np.ndarray]:
    """Trees of a boosted ranker as arrays (feature, threshold, left, right, value), and their weights.

    Read from the saved model's node table; the model's size bounds it, not the data.
    """
    gbt = gbt_stage(r)
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, f"gbt-{uuid.uuid4().hex}")
    gbt.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
        "nodeData.split.featureIndex", F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("cut")).collect()
    trees = []
    for t in range(gbt.getNumTrees):
        of = sorted((x for x in rows if x["treeID"] == t), key=lambda x: x["id"])
        leaf = np.array([x["leftChild"] < 0 for x in of])
        me = np.arange(len(of))
        trees.append({
            "feature": np.where(leaf, 0, [x["featureIndex"] for x in of]),
            "cut": np.array([0.0 if x["cut"] is None else x["cut"] for x in of]),
            # a leaf leads to itself, so rows of all depths walk on together
            "left": np.where(leaf, me, [x["leftChild"] for x in of]),
            "right": np.where(leaf, me, [x["rightChild"] for x in of]),
            "value": np.array([x["prediction"] for x in of])})
    return trees, np.array(gbt.treeWeights)


def prefix_scores(r: Ranker, df: DataFrame, out: str = "preds") -> DataFrame:
    """Add ``out`` (array<double>): element i is the score of the ranker's first i + 1 trees.

    One pass: every tree is walked once per row, and the scores are cumulated.
    """
    trees, weights = _nodes(r)
    gbt = gbt_stage(r)
    ready = PipelineModel(stages=r.model.stages[:-1]).transform(_with_flags(df, r.usable, r.flagged))
    ready = ready.select(*df.columns, vector_to_array(gbt.getFeaturesCol()).alias("_x"))
    width, names = gbt.numFeatures, [*df.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(b.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            row, total = np.arange(len(x)), np.zeros((len(x), len(trees)))
            for t, tree in enumerate(trees):
                at = np.zeros(len(x), dtype=np.int64)
                while True:
                    to = np.where(x[row, tree["feature"][at]] <= tree["cut"][at], tree["left"][at], tree["right"][at])
                    if (to == at).all():
                        break
                    at = to
                total[:, t] = weights[t] * tree["value"][at]
            scores = np.cumsum(total, axis=1).ravel()
            off = np.arange(len(x) + 1, dtype=np.int32) * len(trees)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(pa.array(off), pa.array(scores))],
                                             names=names)

    return ready.mapInArrow(run, T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.DoubleType()))]))


def ndcg_by_rounds(r: Ranker, valid: DataFrame, k: int = 5, label: str = "relevance_grade", by: str = "srch_id",
                   tiebreak: Sequence[str] = ("prop_id", "position")) -> DataFrame:
    """(trees, mean_ndcg, n_searches): mean NDCG@k on ``valid`` of every prefix of the ranker's trees.

    ``valid`` is scored once; (search, prefix) are the groups of one ranking.
    """
    from searchrank.operators import metrics
    from searchrank.sources.io import materialize
    few = valid.select(*dict.fromkeys([c for c in (by, label, *tiebreak)]), *[
        c for c in r.usable if c not in (by, label, *tiebreak)])
    scored = materialize(prefix_scores(r, few).select(*dict.fromkeys([by, label, *tiebreak]), "preds"), "prefix-scores")
    each = scored.select(*dict.fromkeys([by, label, *tiebreak]), F.posexplode("preds").alias("_at", "_score"))
    each = each.withColumn("trees", F.col("_at") + 1)
    return metrics.mean_ndcg(each, by, "_score", label, k, tiebreak=tiebreak, group=["trees"])


def best_rounds(r: Ranker, valid: DataFrame, k: int = 5, step: int = 1, patience: int = 10,
                label: str = "relevance_grade") -> int:
    """Trees after which NDCG@k on ``valid`` is best, looked at every ``step`` trees.

    Looking ends once ``patience`` trees brought nothing better.
    """
    total, best, at = gbt_stage(r).getNumTrees, -1.0, 0
    # one number per tree
    ndcg = {x["trees"]: x["mean_ndcg"] for x in ndcg_by_rounds(r, valid, k, label).collect()}
    for n in [*range(step, total, step), total]:
        one = ndcg.get(n)
        if one is not None and one > best:
            best, at = one, n
        elif n - at >= patience:
            break
    return at or total


def fit_best(train: DataFrame, valid: DataFrame, k: int = 5, label: str = "relevance_grade", **params) -> Ranker:
    """Fit on ``train``, choose the rounds by NDCG@k on ``valid``, then fit on all rows with them (M2)."""
    rounds = best_rounds(fit_ranker(train, label=label, **params), valid, k, label=label)
    return fit_ranker(train.unionByName(valid), label=label, **{**params, "max_iter": rounds})


@dataclass
class Prepared:
    """Training and validation rows with their feature vector, staged once for many fits."""
    train: DataFrame
    valid: DataFrame
    stages: list
    usable: list[str]
    flagged: list[str]
    label: str

    def fit(self, rounds: int, max_depth: int = 5, step_size: float = 0.1, subsample: float = 0.7,
            colsample: float = 0.7, seed: int = 42) -> Ranker:
        """As ``fit_ranker``, without preparing the features again."""
        gbt = GBTRegressor(featuresCol="features", labelCol=self.label, predictionCol="prediction", maxIter=rounds,
                           maxDepth=max_depth, stepSize=step_size, subsamplingRate=subsample,
                           featureSubsetStrategy=str(colsample), seed=seed,
                           checkpointInterval=_checkpoints(rounds), cacheNodeIds=False)
        return Ranker(PipelineModel(stages=[*self.stages, gbt.fit(self.train)]), self.usable, self.flagged, "gbt")

    def ndcg(self, r: Ranker, k: int = 5) -> float:
        from searchrank.operators import metrics
        scored = gbt_stage(r).transform(self.valid).withColumnRenamed("prediction", "pred")
        return metrics.mean_ndcg(scored, score="pred", grade="relevance_grade", k=k).first()["mean_ndcg"] or 0.0


def prepare(train: DataFrame, valid: DataFrame, features: Sequence[str] | None = None,
            label: str = "relevance_grade") -> Prepared:
    """Impute and assemble the features of both sets once (fitted on ``train``)."""
    from searchrank.sources.io import materialize
    ensure_checkpoint_dir(train.sparkSession)
    usable, flagged = _prep_stages(train, list(features or feature_columns(train)))
    prep = Pipeline(stages=_base_stages(usable, flagged)).fit(_with_flags(train, usable, flagged))

    def ready(df: DataFrame) -> DataFrame:
        keep = dict.fromkeys(["srch_id", "prop_id", "position", "relevance_grade", label])
        return prep.transform(_with_flags(df, usable, flagged)).select(*keep, "features")

    return Prepared(materialize(ready(train), "prepared-train"), materialize(ready(valid), "prepared-valid"),
                    list(prep.stages), usable, flagged, label)


def importance(r: Ranker, top: int = 15) -> DataFrame:
    """Per feature: mean split gain, split count and MLlib's normalised
    importance, top ``top`` by gain (M6).

    The fitted trees are written to the shared checkpoint folder and their
    node table (one row per node) is aggregated by Spark.
    """
    gbt = gbt_stage(r)
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, f"gbt-{uuid.uuid4().hex}")
    gbt.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    names = r.feature_names
    name_map = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(i), F.lit(n))])
    splits = nodes.where(F.col("nodeData.split.featureIndex") >= 0).select(
        F.col("nodeData.split.featureIndex").alias("idx"), F.col("nodeData.gain").alias("gain"))
    per = splits.groupBy("idx").agg(F.avg("gain").alias("gain"), F.count(F.lit(1)).alias("weight"))
    imp = gbt.featureImportances.toArray().tolist()   # one value per feature
    imp_map = F.create_map(*[x for i, v in enumerate(imp) for x in (F.lit(i), F.lit(float(v)))])
    out = per.select(name_map[F.col("idx")].alias("feature"), "gain", "weight",
                     imp_map[F.col("idx")].alias("importance"))
    return out.orderBy(F.col("gain").desc(), F.col("feature")).limit(top)
