"""Sinks: feature, segment, model and BI tables, metric reports, fitted models."""

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, functions as F

from ..functions.ordered import union_all
from ..functions.scale import remove


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Overwrite one table. CSV holds no nested types, so arrays are joined with ``;``."""
    if fmt == "csv":
        arrays = [f.name for f in df.schema if f.dataType.typeName() == "array"]
        df = df.withColumns({c: F.concat_ws(";", c) for c in arrays}) if arrays else df
        df.write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)
    return path


def write_tables(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    return {name: write_table(df, f"{base}/{name}", fmt) for name, df in tables.items()}


def save_features(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """Feature tables; entries set to ``None`` are skipped."""
    return write_tables({k: v for k, v in tables.items() if v is not None}, f"{base}/features", fmt)


def save_segments(labels: DataFrame, profiles: DataFrame, base: str, fmt: str = "parquet") -> dict[str, str]:
    return write_tables({"customer_clusters": labels, "cluster_profiles": profiles}, f"{base}/segments", fmt)


def save_models(comparison: DataFrame, importances: DataFrame, model: PipelineModel | None, base: str,
                fmt: str = "parquet") -> dict[str, str]:
    paths = write_tables({"model_comparison": comparison, "feature_importance": importances}, f"{base}/models", fmt)
    if model is not None:
        paths["model"] = save_model(model, f"{base}/models/best_model")
    return paths


def save_rules(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    return write_tables(tables, f"{base}/targeting", fmt)


def metric_rows(df: DataFrame, section: str, key: str | None = None) -> DataFrame:
    """A result table as long metrics: (section, key, metric, value)."""
    numeric = [f.name for f in df.schema if f.name != key and f.dataType.typeName() in
               ("integer", "long", "double", "float", "decimal", "boolean")]
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in numeric]
    label = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(F.lit(section).alias("section"), label.alias("key"), F.explode(F.array(*cells)).alias("c")).select(
        "section", "key", "c.metric", "c.value")


def write_report(sections: dict[str, DataFrame], path: str, keys: dict[str, str] | None = None) -> str:
    """One JSON line per number of the report."""
    keys = keys or {}
    union_all([metric_rows(df, name, keys.get(name)) for name, df in sections.items()]).write.mode("overwrite").json(path)
    return path


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def export_tables(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> DataFrame:
    """Write all tables under ``base`` or, if one fails, none: (dataset, n_rows, n_columns) as observed while writing.

    Tables go to a staging folder beside ``base``, which takes its place when the last one is written; an earlier
    export stays until then. No table is read or computed a second time for its numbers.
    """
    spark = next(iter(tables.values())).sparkSession
    staging, found = f"{base.rstrip('/')}.staging-{uuid.uuid4().hex}", []
    try:
        for name, df in tables.items():
            seen = Observation()
            write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), f"{staging}/{name}", fmt)
            found.append((name, seen.get["n"], len(df.columns)))
        path = spark._jvm.org.apache.hadoop.fs.Path
        files, old = path(base).getFileSystem(spark._jsc.hadoopConfiguration()), f"{staging}.old"
        if files.exists(path(base)):
            files.rename(path(base), path(old))
        if not files.rename(path(staging), path(base)):
            raise OSError(f"{base} could not be put in place")
        remove(spark, old)
    finally:
        remove(spark, staging)
    return spark.createDataFrame(found, "dataset string, n_rows bigint, n_columns int")


def export_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each exported table."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("dataset"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        for name, df in tables.items()])
