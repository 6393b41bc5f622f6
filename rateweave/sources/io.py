"""Sources and sinks (scans, path resolution, report/summary/curve writers, model artifacts)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateweave.session import cut_lineage

# Raw listing schema, snake_case names.  Money columns stay text in the raw file
# ("$1,234") and are parsed by ``clean.parse_money_columns``.
RAW_LISTING_SCHEMA = T.StructType([
    T.StructField("listing_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("host_id", T.LongType()),
    T.StructField("host_identity_verified", T.StringType()),
    T.StructField("host_name", T.StringType()),
    T.StructField("neighbourhood_group", T.StringType()),
    T.StructField("neighbourhood", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("instant_bookable", T.BooleanType()),
    T.StructField("cancellation_policy", T.StringType()),
    T.StructField("room_type", T.StringType()),
    T.StructField("construction_year", T.DoubleType()),
    T.StructField("price", T.StringType()),
    T.StructField("service_fee", T.StringType()),
    T.StructField("minimum_nights", T.DoubleType()),
    T.StructField("number_of_reviews", T.DoubleType()),
    T.StructField("last_review", T.StringType()),
    T.StructField("reviews_per_month", T.DoubleType()),
    T.StructField("review_rate_number", T.DoubleType()),
    T.StructField("calculated_host_listings_count", T.DoubleType()),
    T.StructField("availability_365", T.DoubleType()),
    T.StructField("house_rules", T.StringType()),
    T.StructField("license", T.StringType()),
])

# Inference input contract: name -> role (numerical | categorical).
INFERENCE_SCHEMA = {
    "listing_id": "categorical",
    "price": "numerical",
    "service_fee": "numerical",
    "room_type": "categorical",
    "neighbourhood_group": "categorical",
    "availability_365": "numerical",
    "number_of_reviews": "numerical",
    "reviews_per_month": "numerical",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def open_quotes(spark: SparkSession, paths: Sequence[str]) -> bool:
    """Whether a line has an odd number of quotes, as where a quoted text goes on in the next line."""
    line = F.col("value")
    return not spark.read.text(list(paths)).where((F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1).isEmpty()


def _csv_texts(spark: SparkSession, paths: list[str], multi_line: bool | None) -> tuple[DataFrame, list[str]]:
    """Records as text under the header's names, with what doesn't fit the header and the file, and
    the names."""
    many = open_quotes(spark, paths) if multi_line is None else multi_line
    plain = spark.read.option("header", True).option("escape", '"').option("multiLine", many)
    names = plain.csv(paths).columns
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]
                          + [T.StructField("_misfit", T.StringType())])
    own = plain.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_misfit").schema(schema).csv(paths)
    # written before anything is filtered or pruned: a reader that skips columns doesn't see misfits
    return cut_lineage(own.withColumn("_file", F.col("_metadata.file_path"))), names


def _typed(name: str, own, kinds: dict):
    from rateweave.functions.exprs import parse_number

    kind = kinds.get(name)
    if kind is None or isinstance(kind, T.StringType):
        return own
    return parse_number(own) if isinstance(kind, T.DoubleType) else own.try_cast(kind)


def read_listings(spark: SparkSession, source, schema: T.StructType | None = RAW_LISTING_SCHEMA,
                  fmt: str | None = None, multi_line: bool | None = None) -> DataFrame:
    """Accept a DataFrame (returned as is) or a path (CSV with header, or Parquet).

    CSV quotes double inside quoted text and may hold line breaks.  Columns are found by
    the header's names (as B-1 writes them), not by their place, and those that ``schema``
    names get its types without an inference pass; text that doesn't fit becomes NULL
    (``split_listings`` sets such records apart).  Where no quoted text holds a line break, one
    file is split into several tasks; ``multi_line`` says whether any does, None looks in one pass.
    ``schema=None`` leaves all columns as text under their own names."""
    if isinstance(source, DataFrame):
        return source
    if not isinstance(source, (str, list, tuple)):
        raise TypeError("listing source must be a path or a DataFrame, got " + type(source).__name__)
    paths = [source] if isinstance(source, str) else list(source)
    kind = fmt or ("parquet" if str(paths[0]).rstrip("/").endswith(".parquet") else "csv")
    if kind == "parquet":
        return spark.read.parquet(*paths)
    many = open_quotes(spark, paths) if multi_line is None else multi_line
    text = spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"') \
        .option("multiLine", many).csv(paths)
    if schema is None:
        return text
    from rateweave.operators.clean import normalize_name

    kinds = {f.name: f.dataType for f in schema.fields}
    return text.select(*[_typed(normalize_name(c), F.col(f"`{c}`"), kinds).alias(normalize_name(c)) for c in text.columns])


def split_listings(spark: SparkSession, source: str | Sequence[str], schema: T.StructType = RAW_LISTING_SCHEMA,
                   multi_line: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """CSV records as (good, rejected).  Good ones are those of ``read_listings``.  Rejected are records
    with more or fewer columns than the header, and those with text that doesn't fit its column's
    type (white space alone counts as no text): file, record (the line, or the record's texts as JSON)
    and reasons.  Every record is in one of the two."""
    from rateweave.operators.clean import normalize_name

    own, names = _csv_texts(spark, [source] if isinstance(source, str) else list(source), multi_line)
    kinds, clean = {f.name: f.dataType for f in schema.fields}, [normalize_name(c) for c in names]
    made = {c: _typed(c, F.col(f"c{i}"), kinds) for i, c in enumerate(clean)}
    reasons = [F.when(F.col("_misfit").isNotNull(), F.lit("columns"))]
    reasons += [F.when(F.col("_misfit").isNull() & made[c].isNull() & (F.trim(f"c{i}") != ""),
                       F.concat(F.lit(f"{c}: '"), F.col(f"c{i}"), F.lit(f"' is no {kinds[c].simpleString()}")))
                for i, c in enumerate(clean) if c in kinds and not isinstance(kinds[c], T.StringType)]
    judged = own.withColumn("_reasons", F.array_compact(F.array(*reasons)))
    record = F.coalesce("_misfit", F.to_json(F.struct(*[F.col(f"c{i}").alias(c) for i, c in enumerate(clean)])))
    good = judged.where(F.size("_reasons") == 0).select(*[x.alias(c) for c, x in made.items()])
    rejected = judged.where(F.size("_reasons") > 0).select(F.col("_file").alias("file"), record.alias("record"),
                                                           F.col("_reasons").alias("reasons"))
    return good, rejected


def ingest_listings(spark: SparkSession, source, good_path: str, rejected_path: str, **options) -> None:
    """Good records as Parquet, rejected ones as JSON beside them."""
    good, rejected = split_listings(spark, source, **options)
    good.write.mode("overwrite").parquet(good_path)
    rejected.write.mode("overwrite").json(rejected_path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def resolve_first(spark: SparkSession, paths: Sequence[str]) -> str:
    """First existing path (any Hadoop filesystem); the error lists every candidate."""
    for p in paths:
        if path_exists(spark, p):
            return p
    raise FileNotFoundError("no such path among: " + ", ".join(paths))


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Overwrite a report table.  CSV gets a header row; no index column exists."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A (one-row, possibly nested) summary frame as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_curve(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Persist a demand curve (or feature matrix) as Parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_curve_by_listing(df: DataFrame, table: str, path: str, buckets: int, key: str = "listing_id",
                           order: str = "option_id") -> DataFrame:
    """Persist a curve in ``buckets`` buckets by listing, sorted, as a table at ``path``; what is grouped
    or joined by listing then needs no shuffle.  A bucket is one file, written by one task."""
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, order)
     .option("path", path).format("parquet").saveAsTable(table))
    return df.sparkSession.table(table)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
