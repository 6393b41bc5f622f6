"""Model training, scoring and evaluation with Spark ML (distributed fits).

Regressors: OLS, ridge, random forest, gradient-boosted trees; tuning by a grid search with
folds on a bounded, seeded subset, whose out-of-fold predictions are kept as a table; metrics
in one aggregation.
"""

from __future__ import annotations

import functools
import itertools
import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.functions.exprs import round_half_even_fp
from rateweave.operators.encoders import SPLIT_SEED, build_preprocessor, split_bucket, split_threshold

# Fixed model settings.
RIDGE_ALPHA = 1.0
FOREST_TREES, FOREST_DEPTH = 200, 20
GBT_ITER, GBT_DEPTH, GBT_STEP = 200, 6, 0.1
TUNING_ROWS = 20_000
CV_FOLDS = 3
FOREST_GRID = {"numTrees": [100, 150], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 5]}
GBT_GRID = {"maxIter": [100, 200], "maxDepth": [3, 6], "stepSize": [0.05, 0.1]}
MAX_SPARK_DEPTH = 30
FOREST_NODE_MEMORY_MB = 1024
# Nodes of fitted trees that the driver holds at once, by the bound of nodes_per_tree.
FOREST_NODES = 900_000
FOREST_FITS_AT_ONCE = 3
# Rows from which and up to which tasks grow the trees of such a forest (forest.py): a task holds the
# binned rows, a byte for each feature.  Others are fitted in parts by Spark ML.
GROWN_ROWS = (10_000, 1_000_000)


def tree_depth(depth: int | None) -> int:
    """A tree's depth; None, no limit, is the deepest that Spark's trees go."""
    if depth is None:
        return MAX_SPARK_DEPTH
    if depth > MAX_SPARK_DEPTH:
        raise ValueError(f"trees can't be deeper than {MAX_SPARK_DEPTH}, asked for {depth}")
    return int(depth)


def _estimator(kind: str, label: str, features: str, params: Mapping | None = None, n_train: int | None = None,
               label_std: float | None = None):
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

    p = dict(params or {})
    if kind == "linear":
        return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, solver=p.get("solver", "normal"))
    if kind == "ridge":
        # sklearn's alpha·||w||² on the raw sum of squares equals Spark's
        # regParam = alpha·std(y)/n with labels standardised internally.
        alpha = float(p.get("alpha", RIDGE_ALPHA))
        reg = alpha * float(label_std or 1.0) / float(n_train or 1)
        return LinearRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=0.0,
                                standardization=False, solver=p.get("solver", "l-bfgs"), maxIter=1000, tol=1e-10)
    if kind == "forest":
        return RandomForestRegressor(featuresCol=features, labelCol=label,
                                     numTrees=int(p.get("numTrees", FOREST_TREES)),
                                     maxDepth=tree_depth(p.get("maxDepth", FOREST_DEPTH)),
                                     minInstancesPerNode=int(p.get("minInstancesPerNode", 1)), seed=SPLIT_SEED,
                                     # deep trees: larger node batches per pass and cached node ids
                                     # mean fewer passes over the data (same model family and params)
                                     maxMemoryInMB=FOREST_NODE_MEMORY_MB, cacheNodeIds=True)
    if kind == "gbt":
        return GBTRegressor(featuresCol=features, labelCol=label, maxIter=int(p.get("maxIter", GBT_ITER)),
                            maxDepth=tree_depth(p.get("maxDepth", GBT_DEPTH)), stepSize=float(p.get("stepSize", GBT_STEP)),
                            seed=SPLIT_SEED)
    raise ValueError(f"unknown model kind {kind!r}")


def nodes_per_tree(est, n: int) -> int:
    """A tree's nodes at most: two a row, or those of a full tree of its depth."""
    return max(1, min(2 * n, 2 << est.getMaxDepth()))


def in_parts(est, n: int) -> bool:
    """Whether a regressor is a forest with more nodes on ``n`` rows than the driver holds at once."""
    return type(est).__name__ == "RandomForestRegressor" and est.getNumTrees() * nodes_per_tree(est, n) > FOREST_NODES


def fit_forest_in_parts(est, feats: DataFrame, n: int):
    """The trees of a large forest by some at a time: each part is a forest of its own, with a seed of
    its own, on all rows, saved to the shared folder and let go before the next one is fitted."""
    from rateweave.operators.stages import ForestParts
    from rateweave.session import call_in_context, ensure_checkpoint_dir, in_context

    each = nodes_per_tree(est, n)
    per = max(1, FOREST_NODES // (FOREST_FITS_AT_ONCE * each))
    trees = [min(per, est.getNumTrees() - k) for k in range(0, est.getNumTrees(), per)]
    root = f"{ensure_checkpoint_dir(feats.sparkSession).rstrip('/')}/forests/{uuid.uuid4().hex}"

    def one(k: int) -> str:
        own = est.copy({est.numTrees: trees[k], est.seed: est.getSeed() + 10_007 * k})
        own.fit(feats).write().save(f"{root}/{k}")
        return f"{root}/{k}"

    with ThreadPoolExecutor(max_workers=min(FOREST_FITS_AT_ONCE, max(1, FOREST_NODES // (per * each)))) as pool:
        paths = list(pool.map(call_in_context, in_context(one, range(len(trees)))))
    return ForestParts(paths=paths, trees=trees, together=max(1, FOREST_NODES // (per * each)),
                       featuresCol=est.getFeaturesCol(), predictionCol=est.getPredictionCol())


def fit_large_forest(est, feats: DataFrame, n: int):
    """A forest with more nodes than the driver holds at once: its trees grown in tasks, or fitted in parts."""
    from rateweave.operators import forest

    width = feats.select(F.size(vector_to_array(est.getFeaturesCol()))).first()[0]
    if est.getNumTrees() > 1 and width <= forest.MAX_FEATURES and GROWN_ROWS[0] <= n <= GROWN_ROWS[1]:
        return forest.fit_grown_forest(est, feats, n, feats.sparkSession.sparkContext.defaultParallelism)
    return fit_forest_in_parts(est, feats, n)


def fit_model(train: DataFrame, kind: str, numeric: Sequence[str], categorical: Sequence[str],
              label: str = "demand_score", params: Mapping | None = None):
    """E-1..E-4: preprocessor + regressor as one PipelineModel (saveable, A-7)."""
    from pyspark.ml import Pipeline, PipelineModel

    from rateweave.session import cut_lineage

    st = train.agg(F.count(label).alias("n"), F.stddev_samp(label).alias("s")).first()
    prep = build_preprocessor(numeric, categorical, label=label)
    est = _estimator(kind, label, "features", params, st["n"], st["s"])
    if not in_parts(est, st["n"]):
        return Pipeline(stages=[*prep.getStages(), est]).fit(train)
    fitted = prep.fit(train)
    feats = cut_lineage(fitted.transform(train).select("features", label))
    return PipelineModel(stages=[*fitted.stages, fit_large_forest(est, feats, st["n"])])


def regression_metrics(pred: DataFrame, label: str = "demand_score", prediction: str = "prediction") -> DataFrame:
    """E-7: RMSE, MAE, R² in one aggregation (R² via regr_syy, a stable n·var_pop)."""
    err = F.col(label) - F.col(prediction)
    return pred.agg(
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.sum(err * err) / F.regr_syy(F.col(label), F.col(prediction))).alias("r2"),
    )


def compare_models(models: Mapping[str, object], test: DataFrame, label: str = "demand_score") -> DataFrame:
    """E-8: one metrics row per fitted model (absent ones skipped), 4 decimals, by R² desc."""
    rows = None
    for i, (name, m) in enumerate(models.items()):
        if m is None:
            continue
        r = regression_metrics(m.transform(test), label).select(
            F.lit(name).alias("model"), F.lit(i).alias("_order"), "rmse", "mae", "r2")
        rows = r if rows is None else rows.unionByName(r)
    if rows is None:
        raise ValueError("no model to compare")
    return rows.select("model", "_order", *[round_half_even_fp(c, 4).alias(c) for c in ("rmse", "mae", "r2")]).orderBy(
        F.desc("r2"), "_order")


def select_best(metrics: DataFrame) -> DataFrame:
    """E-9: best model by R², first (lowest order) wins ties."""
    return metrics.agg(F.max_by("model", F.struct(F.col("r2"), -F.col("_order"))).alias("best_model"))


def tuning_subset(df: DataFrame, n: int = TUNING_ROWS, key: str = "listing_id", seed: int = SPLIT_SEED) -> DataFrame:
    """E-6: the n rows with the smallest seeded hash of the key.  A threshold on the hash, from
    the number of rows, leaves little more than n rows before they are ordered; the result is
    dealt out again, so that fits on it run in parallel."""
    bucket, total = split_bucket(key, seed + 1), df.count()
    few, share = df, 1.2 * n / max(total, 1)
    while share < 1.0:
        few = df.where(bucket < F.lit(split_threshold(share)))
        if few.count() >= n:
            break
        few, share = df, share * 1.5
    return few.orderBy(bucket, key).limit(n).repartition(max(2, df.sparkSession.sparkContext.defaultParallelism))


def fold_of(key: str, folds: int, seed: int = SPLIT_SEED) -> Column:
    """A row's fold, by a hash of its key: the same on every run and however rows are dealt."""
    return (F.conv(split_bucket(key, seed + 2), 16, 10).cast("long") % folds).cast("int")


def grid_points(grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of a grid, the last name changing fastest."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def grid_search(train: DataFrame, kind: str, numeric: Sequence[str], categorical: Sequence[str],
                grid: Mapping[str, Sequence] | None = None, label: str = "demand_score", folds: int = CV_FOLDS,
                subset_rows: int = TUNING_ROWS, key: str = "listing_id", parallel: int = 4
                ) -> tuple[list[dict], DataFrame, DataFrame]:
    """E-5: the points of the grid, the out-of-fold predictions (point, fold, key, label, prediction)
    and the scores (point, fold, rows, r2) that these predictions give.

    The preprocessor is fitted once on the tuning subset and its features are written once; each
    (point, fold) is a fit of its own on the other folds, some at a time, whose predictions are
    written.  Rows without a label are left out.  An empty fold has no rows and no score."""
    from rateweave.session import call_in_context, cut_lineage, in_context

    points = grid_points(grid or (FOREST_GRID if kind == "forest" else GBT_GRID))
    subset = cut_lineage(tuning_subset(train.where(F.col(label).isNotNull()), subset_rows))
    prep = build_preprocessor(numeric, categorical, label=label).fit(subset)
    feats = cut_lineage(prep.transform(subset).select(key, fold_of(key, folds).alias("fold"), label, "features"))

    def one(job: tuple[int, int]) -> DataFrame:
        point, fold = job
        rest = feats.where(F.col("fold") != fold)
        st = rest.agg(F.count(label).alias("n"), F.stddev_samp(label).alias("s")).first() if kind == "ridge" else None
        fitted = _estimator(kind, label, "features", points[point], *(st or ())).fit(rest)
        return cut_lineage(fitted.transform(feats.where(F.col("fold") == fold)).select(
            F.lit(point).alias("point"), "fold", key, label, "prediction"))

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        jobs = in_context(one, itertools.product(range(len(points)), range(folds)))
        written = list(pool.map(call_in_context, jobs))
    predictions = functools.reduce(DataFrame.unionByName, written)
    return points, predictions, fold_scores(predictions, label)


def fold_scores(predictions: DataFrame, label: str = "demand_score") -> DataFrame:
    """(point, fold, rows, r2) of out-of-fold predictions."""
    err = F.col(label) - F.col("prediction")
    return predictions.groupBy("point", "fold").agg(F.count(F.lit(1)).alias("rows"), (
        F.lit(1.0) - F.try_divide(F.sum(err * err), F.regr_syy(F.col(label), F.col("prediction")))).alias("r2"))


def best_point(scores: DataFrame) -> int:
    """The point with the largest mean R², the first of equals."""
    mean = scores.groupBy("point").agg(F.avg("r2").alias("m"))
    return int(mean.agg(F.max_by("point", F.struct(F.coalesce("m", F.lit(float("-inf"))), -F.col("point")))).first()[0])


def tune(train: DataFrame, kind: str, numeric: Sequence[str], categorical: Sequence[str],
         grid: Mapping[str, Sequence] | None = None, label: str = "demand_score", folds: int = CV_FOLDS,
         subset_rows: int = TUNING_ROWS, parallelism: int = 4, key: str = "listing_id"):
    """E-5: grid search on a tuning subset, then the best point refit on all of train."""
    points, _, scores = grid_search(train, kind, numeric, categorical, grid, label, folds, subset_rows, key, parallelism)
    best = points[best_point(scores)]
    return fit_model(train, kind, numeric, categorical, label, best), best


def staged_losses(model, data: DataFrame, validation: DataFrame | None = None) -> DataFrame:
    """E-4: the squared loss after each round of boosting (round from 1, train_loss and, with
    ``validation``, validation_loss and whether the round is the best one, the first of equals)."""
    *before, boosted = model.stages
    featured = [functools.reduce(lambda d, st: st.transform(d), before, d) for d in (data, validation) if d is not None]
    losses = [[float(x) for x in boosted.evaluateEachIteration(d, "squared")] for d in featured]
    rows = [(k + 1, *at) for k, at in enumerate(zip(*losses))]
    out = data.sparkSession.createDataFrame(rows, "round int, train_loss double" + (
        ", validation_loss double" if validation is not None else ""))
    if validation is None:
        return out
    best = min(range(len(rows)), key=lambda k: (rows[k][2], k)) + 1
    return out.withColumn("is_best", F.col("round") == best)


def score(df: DataFrame, model, key: str = "listing_id", price: str = "price") -> DataFrame:
    """E-11: predict demand and build id, price, demand_before, revenue_before (not clipped)."""
    pred = model.transform(df)
    return pred.select(
        F.col(key).alias("listing_id"), F.col(price).alias("current_price"),
        F.col("prediction").alias("predicted_demand_before"),
        (F.col(price) * F.col("prediction")).alias("predicted_revenue_before"))


def run_record(name: str, params: Mapping, metrics_row, started: float) -> dict:
    """E-10: one training-run record (params, metrics, duration)."""
    return {"run_name": name, "params": {k: str(v) for k, v in params.items()},
            "rmse": metrics_row["rmse"], "mae": metrics_row["mae"], "r2": metrics_row["r2"],
            "duration_sec": time.time() - started}


def train_and_log(train: DataFrame, test: DataFrame, kinds: Sequence[str], numeric: Sequence[str],
                  categorical: Sequence[str], path: str, label: str = "demand_score",
                  params: Mapping[str, Mapping] | None = None) -> tuple[dict, DataFrame]:
    """H-3 with its log: the fitted models and their comparison; a run of each model, with its settings,
    row counts, metrics and duration, is appended to the table at ``path``."""
    from rateweave.session import cut_lineage

    params = dict(params or {})
    sizes = {"train_rows": train.count(), "test_rows": test.count()}
    started = time.time()
    models = train_models(train, kinds, numeric, categorical, label, params)
    compared = cut_lineage(compare_models(models, test, label))
    append_runs(train.sparkSession, [run_record(r["model"], {**sizes, **params.get(r["model"], {})}, r, started)
                                     for r in compared.collect()], path)
    return models, compared


def append_runs(spark, records: Sequence[dict], path: str) -> None:
    """E-10: append run rows to a Parquet table."""
    spark.createDataFrame(list(records)).write.mode("append").parquet(path)


def fit_simple_linear(train: DataFrame, x: str, label: str = "demand_score"):
    """E-1 on one feature (normal-equation OLS with intercept)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    return Pipeline(stages=[
        VectorAssembler(inputCols=[x], outputCol="features", handleInvalid="skip"),
        LinearRegression(featuresCol="features", labelCol=label, regParam=0.0, solver="normal"),
    ]).fit(train.filter(F.col(x).isNotNull() & F.col(label).isNotNull()))


def stage_reads(stage) -> dict[str, list[str]] | None:
    """Inputs of each output of a fitted stage; None for a stage that doesn't tell."""
    if hasattr(stage, "reads"):
        return stage.reads()
    said = lambda p: stage.getOrDefault(p) if stage.hasParam(p) and stage.isDefined(p) else None
    if stage.hasParam("predictionCol"):
        return {said("predictionCol"): [said("featuresCol")]}
    outs = said("outputCols") if stage.hasParam("outputCols") and stage.isSet("outputCols") else None
    ins = said("inputCols") if stage.hasParam("inputCols") and stage.isSet("inputCols") else None
    if outs and ins and len(outs) == len(ins):
        return {o: [i] for o, i in zip(outs, ins)}
    ins = ins or ([said("inputCol")] if said("inputCol") else None)
    return {said("outputCol"): ins} if ins and said("outputCol") else None


def split_by_input(stages: Sequence, changed: str) -> tuple[list, list]:
    """Fitted stages as (those that can run once, those to run again whenever ``changed`` changes).  A
    stage that can be cut down to some outputs is in both; one that doesn't tell what it reads, and
    all that follow, are run again."""
    once, again, moved, dark = [], [], {changed}, False
    for stage in stages:
        reads = stage_reads(stage)
        dark = dark or reads is None
        hit = [] if reads is None else [o for o, ins in reads.items() if dark or moved & set(ins)]
        if not dark and not hit:
            once.append(stage)
        elif dark or len(hit) == len(reads) or not hasattr(stage, "only"):
            again.append(stage)
            moved |= set(reads or ())
        else:
            once.append(stage.only([o for o in reads if o not in hit]))
            again.append(stage.only(hit))
            moved |= set(hit)
    return once, again


def model_curve(listings: DataFrame, model, n: int = 15, lo_f: float = 0.8, hi_f: float = 1.2,
                clip: bool = True, repartition: int | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """F-4: every listing × bounded candidate grid -> replace price -> model -> demand clipped at 0 ->
    F-4 columns.  Stages that don't read the price (texts, indexes and indicators of categories, the
    other numbers) run once per listing before the explode; only what reads the price runs for each
    candidate.  The explode is row-local.  ``repartition`` spreads listings that come in few partitions
    over more tasks before they are exploded; ``carry`` names more columns to take along."""
    from rateweave.operators import curves
    from rateweave.functions.exprs import clip_lower

    once, again = split_by_input(model.stages, "price")
    base = functools.reduce(lambda d, st: st.transform(d), once, listings.withColumn("current_price", F.col("price")))
    grid = curves.price_grid("current_price", n, lo_f, hi_f)
    ex = curves.explode_grid(base, grid, repartition=repartition).withColumn("price", F.col("candidate_price"))
    pred = functools.reduce(lambda d, st: st.transform(d), again, ex)
    dem = clip_lower(F.col("prediction"), 0.0) if clip else F.col("prediction")
    out = curves.curve_columns(pred.withColumn("predicted_demand", dem))
    keep = [c for c in ("room_type", "neighbourhood_group", "competitor_avg_price") if c in out.columns]
    return out.select("listing_id", "option_id", "current_price", "candidate_price", "predicted_demand",
                      "expected_revenue", "price_change", "price_change_pct", *keep, *[c for c in carry if c not in keep])


def train_models(train: DataFrame, kinds: Sequence[str], numeric: Sequence[str], categorical: Sequence[str],
                 label: str = "demand_score", params: Mapping[str, Mapping] | None = None,
                 parallel: int = 4) -> dict:
    """H-3 training stage: fit the preprocessor once, materialise (features, label)
    once in the shared checkpoint directory, then fit every regressor on that
    table, concurrently (each fit is its own set of distributed jobs).  Each
    returned model is a full PipelineModel: shared fitted preprocessing stages
    plus its regressor, so it scores raw listing rows."""
    from pyspark.ml import PipelineModel

    from rateweave.session import cut_lineage

    params = dict(params or {})
    prep = build_preprocessor(numeric, categorical, label=label).fit(train)
    feats = cut_lineage(prep.transform(train).select("features", label))
    st = feats.agg(F.count(label).alias("n"), F.stddev_samp(label).alias("s")).first()

    def fit_one(kind: str):
        est = _estimator(kind, label, "features", params.get(kind), st["n"], st["s"])
        fitted = fit_large_forest(est, feats, st["n"]) if in_parts(est, st["n"]) else est.fit(feats)
        return kind, PipelineModel(stages=[*prep.stages, fitted])

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return dict(pool.map(fit_one, list(kinds)))
