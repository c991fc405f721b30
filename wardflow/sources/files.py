"""File sources and sinks: the encounter CSV, the sectioned code-map file,
metric and confusion-matrix sinks, and Parquet landing."""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.schema import RAW_SCHEMA
from wardflow.session import written

# The admission-type, discharge-disposition and admission-source
# code maps shipped with the encounter dataset, kept verbatim (leading blanks,
# quoted commas, out-of-order and missing codes) because the reader must cope
# with exactly that layout.
CODE_MAP_RESOURCE = ("wardflow.sources", "data/id_code_maps.csv")


def code_map_text() -> str:
    """The packaged file's text; also readable where the package lies in a zip."""
    package, name = CODE_MAP_RESOURCE
    return files(package).joinpath(name).read_text(encoding="utf-8")


def read_encounters(spark: SparkSession, path: str, fmt: str = "csv",
                    schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Scan the raw encounter file with an explicit all-string schema (no inference pass).

    A CSV's header must name the schema's columns in their order, or the fields would
    load into each other's columns: the first line is compared at once
    (ValueError names what differs), every other file's header when it is read. Lines
    with too few or too many fields are :func:`read_encounters_checked`'s matter.
    """
    if fmt == "csv":
        check_header(spark, path, schema)
        return _csv(spark, schema).csv(path)
    return spark.read.schema(schema).format(fmt).load(path)


def _csv(spark: SparkSession, schema: T.StructType):
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")


def check_header(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> None:
    """ValueError if the first line of the file(s) isn't the schema's header; a folder without lines passes."""
    line = spark.read.text(path).limit(1).select(F.split("value", ",").alias("names")).first()
    if line is None:
        return
    found = [x.strip().strip('"').lstrip("\ufeff") for x in line["names"]]
    if found == schema.names:
        return
    missing, surplus = [c for c in schema.names if c not in found], [c for c in found if c not in schema.names]
    place = next((i for i, (a, b) in enumerate(zip(found, schema.names)) if a != b), min(len(found), len(schema.names)))
    raise ValueError(f"CSV header of {path} doesn't match the schema: missing {missing}, unknown {surplus}, "
                     f"first difference at column {place + 1} of {len(found)} (expected {schema.names[place:place + 1]}, found {found[place:place + 1]})")


REJECT_COLUMNS = ["file", "reason", "line"]


def read_encounters_checked(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a header CSV: a line with too few or too many fields is a reject with its file and ``fields:<n>``.

    The file is parsed once, into a written table from which both come; their rows add up to its lines.
    """
    check_header(spark, path, schema)
    own = "__line"
    whole = T.StructType([*schema.fields, T.StructField(own, T.StringType())])
    parsed = _csv(spark, whole).option("columnNameOfCorruptRecord", own).csv(path).withColumn("__file", F.col("_metadata.file_path"))
    every = written(parsed, "parsed-csv")
    fields = F.size(F.split(own, r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1))  # commas outside quotes
    rejects = every.where(F.col(own).isNotNull()).select(
        F.col("__file").alias("file"), F.concat(F.lit("fields:"), fields.cast("string")).alias("reason"), F.col(own).alias("line"))
    return every.where(F.col(own).isNull()).drop(own, "__file"), rejects


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def land_parquet(df: DataFrame, path: str, partitions: int | None = None) -> str:
    """Write ``df`` as Parquet (columnar, so later scans prune columns and push filters)."""
    out = df.repartition(partitions) if partitions else df
    out.write.mode("overwrite").parquet(path)
    return path


def read_code_maps(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Sectioned code-map file(s) -> ``(map_name, code, description)``.

    ``path`` names file(s) that all executors can read; without it the map
    shipped with the package is used, whose text travels in the plan.
    Each file holds several ``<name>,description`` sections separated by a
    ``,`` line. A file is read whole (one row), split into numbered lines, and
    each line takes the name of the nearest header above it in the same file.
    Quoted commas are parsed by ``from_csv``; descriptions are trimmed; the
    text ``NULL`` is kept as text.
    """
    if path is None:
        raw = spark.createDataFrame([("packaged", code_map_text())], "file string, value string")
    else:
        raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    lines = raw.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("pos", "line"))
    lines = lines.where(F.trim("line") != "")
    parsed = lines.select("file", "pos", F.from_csv("line", "code STRING, description STRING").alias("r"))
    parsed = parsed.select("file", "pos", F.trim("r.code").alias("code"), F.trim("r.description").alias("description"))
    is_header = F.col("description") == F.lit("description")
    is_separator = F.col("code").isNull() & F.col("description").isNull()
    w = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = parsed.withColumn("map_name", F.last(F.when(is_header, F.col("code")), ignorenulls=True).over(w))
    return (named.where(~is_header & ~is_separator & F.col("map_name").isNotNull())
            .select("map_name", "code", "description"))


def write_metrics(df: DataFrame, path: str) -> str:
    """Metrics sink: a (small) metrics DataFrame written as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_metrics(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_confusion(df: DataFrame, path: str) -> str:
    """Confusion-matrix sink as CSV with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


CONFUSION_SCHEMA = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("pred_0", T.LongType()),
                                 T.StructField("pred_1", T.LongType())])


def read_confusion(spark: SparkSession, path: str, schema: T.StructType = CONFUSION_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
