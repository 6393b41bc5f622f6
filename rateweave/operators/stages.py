"""Pipeline stages of the feature step, the median fill and the scaler, saved with a pipeline.

They are built from column expressions, so a pipeline with them stays free of Python workers.
Each says which inputs an output is made of (``reads``) and can be cut down to some outputs
(``only``): ``models.model_curve`` recomputes for each candidate price just what reads the price.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.functions.exprs import finite_or_null, log1p_clip
from rateweave.session import call_in_context, cut_lineage, in_context


class _Outputs(Params):
    """Outputs to make; none set: all whose inputs are there."""

    outputs = Param(Params._dummy(), "outputs", "outputs to make", TypeConverters.toListString)

    def reads(self) -> dict[str, list[str]]:
        raise NotImplementedError

    def wanted(self) -> list[str]:
        return self.getOrDefault("outputs") if self.isSet("outputs") else list(self.reads())

    def only(self, outputs: Sequence[str]):
        """The same stage for some outputs."""
        return self.copy({self.getParam("outputs"): list(outputs)})


class ListingFeatures(Transformer, _Outputs, DefaultParamsReadable, DefaultParamsWritable):
    """D-12: price_log, price_per_minimum_night and room_type_neighbourhood, each only if the frame
    has its inputs."""

    READS = {"price_log": ["price"], "price_per_minimum_night": ["price", "minimum_nights"],
             "room_type_neighbourhood": ["room_type", "neighbourhood_group"]}

    def reads(self) -> dict[str, list[str]]:
        return dict(self.READS)

    def _transform(self, df: DataFrame) -> DataFrame:
        made = {
            "price_log": lambda: log1p_clip(F.col("price").cast("double")),
            "price_per_minimum_night": lambda: F.try_divide(F.col("price"), F.col("minimum_nights") + F.lit(1.0)),
            "room_type_neighbourhood": lambda: F.concat(F.coalesce("room_type", F.lit("nan")), F.lit("_"),
                                                        F.coalesce("neighbourhood_group", F.lit("nan")))}
        return df.withColumns({c: made[c]() for c in self.wanted() if set(self.READS[c]) <= set(df.columns)})


class CategoryTexts(Transformer, _Outputs, DefaultParamsReadable, DefaultParamsWritable):
    """``<c>__c``: a category as text, 'missing' for NULL."""

    inputCols = Param(Params._dummy(), "inputCols", "categories", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def reads(self) -> dict[str, list[str]]:
        return {f"{c}__c": [c] for c in self.getOrDefault("inputCols")}

    def _transform(self, df: DataFrame) -> DataFrame:
        reads = self.reads()
        return df.withColumns({c: F.coalesce(F.col(reads[c][0]).cast("string"), F.lit("missing")) for c in self.wanted()})


class _MedianScaling(_Outputs):
    inputCols = Param(Params._dummy(), "inputCols", "numeric columns", TypeConverters.toListString)

    def reads(self) -> dict[str, list[str]]:
        return {f"{c}__z": [c] for c in self.getOrDefault("inputCols")}


class MedianScaler(Estimator, _MedianScaling, DefaultParamsReadable, DefaultParamsWritable):
    """D-15 and D-16: fits each column's exact median, and the mean and population deviation of the
    column with its gaps (NULL, NaN, infinities) filled by it.  A column without values has median 0."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> MedianScalerModel:
        from rateweave.operators.encoders import fit_median_imputer

        cols = self.getOrDefault("inputCols")
        own = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
        medians = fit_median_imputer(own, cols).values if cols else {}
        filled = [F.coalesce(finite_or_null(F.col(c)), F.lit(float(medians[c]))) for c in cols]
        s = own.agg(F.count(F.lit(1)).alias("n"), *[f(x).alias(f"{name}{i}") for i, x in enumerate(filled)
                                                    for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        model = MedianScalerModel()
        model._set(inputCols=cols, medians=[float(medians[c]) for c in cols],
                   means=[s[f"m{i}"] or 0.0 for i in range(len(cols))],
                   deviations=[s[f"s{i}"] or 0.0 for i in range(len(cols))])
        return model


class MedianScalerModel(Model, _MedianScaling, DefaultParamsReadable, DefaultParamsWritable):
    """``<c>__z``: (value or median - mean) / deviation, a deviation of 0 counting as 1."""

    medians = Param(Params._dummy(), "medians", "fills", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "means", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "population deviations", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        fits = zip(self.getOrDefault("inputCols"), *(self.getOrDefault(p) for p in ("medians", "means", "deviations")))
        made = {f"{c}__z": (F.coalesce(finite_or_null(F.col(c).cast("double")), F.lit(median)) - F.lit(mean)) / F.lit(dev or 1.0)
                for c, median, mean, dev in fits}
        return df.withColumns({c: made[c] for c in self.wanted()})


class ForestParts(Model, HasFeaturesCol, HasPredictionCol, MLReadable, MLWritable):
    """A forest too large for the driver: its trees stand in saved forests at ``paths``, ``trees`` of
    them in each.  A row's prediction is the mean over all trees.  Rows are written once and scored by
    ``together`` parts at a time, so that the driver and each executor hold no more trees than these."""

    paths = Param(Params._dummy(), "paths", "saved forests", TypeConverters.toListString)
    trees = Param(Params._dummy(), "trees", "trees of each", TypeConverters.toListInt)
    together = Param(Params._dummy(), "together", "parts to hold at once", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, paths=None, trees=None, together=1, featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def getNumTrees(self) -> int:
        return sum(self.getOrDefault("trees"))

    def forests(self) -> Iterator:
        """The parts one by one, as ordinary forests."""
        from pyspark.ml.regression import RandomForestRegressionModel

        return (RandomForestRegressionModel.load(path) for path in self.getOrDefault("paths"))

    def _scored(self, rows: DataFrame, at: Sequence[int]) -> DataFrame:
        """The sum of the predictions of all trees of some parts, by row."""
        from pyspark.ml.regression import RandomForestRegressionModel

        paths, trees = self.getOrDefault("paths"), self.getOrDefault("trees")
        with ThreadPoolExecutor(max_workers=len(at)) as pool:
            parts = list(pool.map(call_in_context, in_context(RandomForestRegressionModel.load, [paths[k] for k in at])))
        out = rows.select("_row", self.getFeaturesCol())
        for k, part in zip(at, parts):
            out = part.setFeaturesCol(self.getFeaturesCol()).setPredictionCol(f"_p{k}").transform(out)
        total = functools.reduce(lambda a, b: a + b, [F.col(f"_p{k}") * F.lit(float(trees[k])) for k in at])
        return cut_lineage(out.select("_row", F.lit(at[0]).alias("_at"), total.alias("_sum")))

    def _transform(self, df: DataFrame) -> DataFrame:
        rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
        n, together = len(self.getOrDefault("paths")), self.getOrDefault("together")
        sums = [self._scored(rows, range(k, min(n, k + together))) for k in range(0, n, together)]
        by_row = functools.reduce(DataFrame.unionByName, sums).groupBy("_row").agg(
            F.array_sort(F.collect_list(F.struct("_at", "_sum"))).alias("_all"))         # added in the order of the parts
        mean = F.aggregate("_all", F.lit(0.0), lambda a, x: a + x["_sum"]) / F.lit(float(self.getNumTrees))
        return rows.join(by_row.select("_row", mean.alias(self.getPredictionCol())), "_row").drop("_row")

    def write(self) -> MLWriter:
        return _ForestPartsWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _ForestPartsReader(cls)


class _ForestPartsWriter(DefaultParamsWriter):
    """The parameters and a copy of each part: a saved forest reads nothing outside its own folder."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        for k, part in enumerate(self.instance.forests()):
            part.write().save(f"{path}/parts/{k}")


class _ForestPartsReader(DefaultParamsReader):
    def load(self, path: str) -> ForestParts:
        own = super().load(path)
        return own._set(paths=[f"{path}/parts/{k}" for k in range(len(own.getOrDefault("trees")))])
