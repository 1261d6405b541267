"""Typed readers for the three input datasets."""

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

# Input schemas
PORTFOLIO_SCHEMA = "id string, offer_type string, difficulty int, reward int, duration double, channels array<string>"
PROFILE_SCHEMA = "id string, age int, became_member_on int, gender string, income double"
TRANSCRIPT_SCHEMA = "person string, event string, time int, value map<string,string>"


class Datasets(NamedTuple):
    portfolio: DataFrame
    profile: DataFrame
    transcript: DataFrame


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of a JSON array or a JSON-lines file, and the lines that do not parse.

    The first non-blank line decides the layout. An array that does not parse as a whole is read line by line, without
    its brackets and the commas between objects, and its bad lines are reported. Spark reads an array file in one task;
    large inputs should be lines. A missing path raises ``FileNotFoundError``.
    """
    try:
        lines = spark.read.text(path)
        head = lines.filter(F.trim("value") != "").first()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise
    is_array = head is not None and head["value"].lstrip().startswith("[")
    if schema is None:
        sample = spark.read.option("multiLine", is_array).option("mode", "DROPMALFORMED").json(path)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sample.schema if f.name != "_corrupt_record")
    if is_array:
        whole = spark.read.schema(f"{schema}, _bad string").option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").json(path).persist()  # the parsed rows decide
        if whole.filter("_bad is not null").isEmpty():
            return whole.drop("_bad"), lines.filter(F.lit(False)).withColumnRenamed("value", "line")
        lines = lines.select(F.regexp_replace(F.trim("value"), r"^\[\s*|\s*,$|\s*\]$", "").alias("value"))
    # Keep the raw line beside the parsed row: the rejects then need no cached parse.
    parsed = lines.filter(F.trim("value") != "").select(
        "value", F.from_json("value", f"{schema}, _bad string",
                             {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("row"))
    bad = F.col("row").isNull() | F.col("row._bad").isNotNull()
    good = parsed.filter(~bad).select("row.*").drop("_bad")
    return good, parsed.filter(bad).select(F.col("value").alias("line"))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def load_datasets(spark: SparkSession, base: str) -> Datasets:
    return Datasets(
        read_json(spark, f"{base}/portfolio.json", PORTFOLIO_SCHEMA)[0],
        read_json(spark, f"{base}/profile.json", PROFILE_SCHEMA)[0],
        read_json(spark, f"{base}/transcript.json", TRANSCRIPT_SCHEMA)[0],
    )


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A stored table: Parquet, or CSV with a header when a schema is given."""
    if schema is not None:
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.parquet(path)
