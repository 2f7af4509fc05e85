"""Text sources and sinks: FASTA, deflines, delimited tables, manifests, nested measurement tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A measurement table as its laboratory sends it: antigens, sera, and per cell a list of readings.
NESTED = T.StructType(
    [
        T.StructField("table_id", T.StringType()),
        T.StructField("lab", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("antigens", T.ArrayType(T.StringType())),
        T.StructField("sera", T.ArrayType(T.StringType())),
        T.StructField("titres", T.ArrayType(T.ArrayType(T.ArrayType(T.StringType())))),
    ]
)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(defline, sequence) of FASTA files; records are split on the marker, so long files are read in parallel."""
    records = spark.read.option("lineSep", "\n>").text(path)
    text = F.regexp_replace(F.col("value"), r"^>", "")
    parts = F.split(text, "\n", 2)
    body = F.regexp_replace(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), r"\s", "")
    return records.where(F.trim("value") != "").select(F.trim(F.element_at(parts, 1)).alias("defline"), body.alias("sequence"))


def write_fasta(rows: DataFrame, path: str, name: str = "name", sequence: str = "sequence") -> None:
    rows.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col(sequence)).alias("value")).write.mode("overwrite").text(path)


def defline_fields(defline) -> tuple:
    """(name, fields) of a defline `name|key=value|...`."""
    parts = F.split(defline, r"\|")
    pairs = F.filter(parts, lambda p: F.contains(p, F.lit("=")))
    fields = F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.split_part(p, F.lit("="), F.lit(1)).alias("k"), F.substring_index(p, "=", -1).alias("v"))))
    return F.element_at(parts, 1), fields


def check_alignment(rows: DataFrame) -> DataFrame:
    """What is wrong with an alignment: names that repeat, or sequences of another length than the most common."""
    lengths = rows.groupBy(F.length("sequence").alias("length")).count()
    usual = lengths.agg(F.max_by("length", F.struct("count", "length")).alias("usual"))  # one row
    odd = rows.join(F.broadcast(usual)).where(F.length("sequence") != F.col("usual")).select("name", F.lit("length").alias("problem"))
    repeated = rows.groupBy("name").count().where("count > 1").select("name", F.lit("repeated").alias("problem"))
    return odd.unionByName(repeated)


def read_nested(spark: SparkSession, path: str) -> DataFrame:
    """Nested measurement tables from JSON, with the declared schema."""
    return spark.read.schema(NESTED).json(path)


def flatten(tables: DataFrame) -> DataFrame:
    """One row per reading: table_id, lab, date, antigen, serum, reading number and token."""
    cells = tables.select("table_id", "lab", "date", "antigens", "sera", F.posexplode("titres").alias("a", "row"))
    cells = cells.select("table_id", "lab", "date", "antigens", "sera", "a", F.posexplode("row").alias("s", "cell"))
    readings = cells.select("table_id", "lab", "date", F.get("antigens", F.col("a")).alias("antigen"), F.get("sera", F.col("s")).alias("serum"), F.posexplode("cell").alias("reading", "token"))
    return readings


def read_union(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet of several versions by column name; a column that an older one lacks is NULL."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def rule_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A tab-separated rule file with its line numbers; a missing or unknown column is an error."""
    header = [c.strip() for c in (spark.read.text(path).first() or [""])[0].split("\t")]
    if sorted(header) != sorted(columns):
        raise ValueError(f"{path}: columns {header}, expected {list(columns)}")
    # a rule file is curated and small: one task reads it, so the order of the ids is that of the lines
    lines = spark.read.option("wholetext", True).text(path).select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))
    lines = lines.where((F.col("line") > 0) & (F.trim("text") != ""))
    cells = F.split("text", "\t")
    return lines.select(*[F.trim(F.get(cells, F.lit(i))).alias(c) for i, c in enumerate(header)], F.col("line").alias("rule_line"))


def text_dump(rows: DataFrame, key: str) -> DataFrame:
    """Rows as text for comparing by eye, in key order."""
    return rows.orderBy(key).select(F.to_json(F.struct("*")).alias("value"))
