"""Registry extracts, lookup lists and work queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from actaspark.functions import ids, text
from actaspark.plans import schemas
from actaspark.plans.shared import shared_dir

from .cache import listed, newest


def csv(spark: SparkSession, path: str | list[str], schema: str, encoding: str = "UTF-8", sep: str = ",", header: bool = True) -> DataFrame:
    """A CSV table; columns are matched by position to the header's names."""
    return spark.read.csv(path, schema=schema, header=header, sep=sep, encoding=encoding, quote='"', escape='"', enforceSchema=False) if header else spark.read.csv(path, schema=schema, sep=sep, encoding=encoding)


def read_text_column(spark: SparkSession, path: str, name: str, encoding: str = "UTF-8", sep: str = ";") -> DataFrame:
    """The first column of a file without a header."""
    return csv(spark, path, f"{name} string", encoding, sep, header=False)


def encodings(spark: SparkSession, paths: list[str], other: str = "ISO-8859-1") -> dict[str, str]:
    """The encoding of each file: UTF-8 if all its lines are, else ``other``. Lines are tested where they are read, so a
    large file is tested by many tasks."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.is_valid_utf8("value").alias("good"))
    bad = {r["path"] for r in lines.groupBy("path").agg(F.bool_and("good").alias("good")).filter("not good").collect()}
    every = [r["path"] for r in spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("path")).collect()]
    return {path: other if path in bad else "UTF-8" for path in every}


def csv_any(spark: SparkSession, paths: list[str], schema: str, sep: str = ",", header: bool = True, other: str = "ISO-8859-1") -> DataFrame:
    """CSV files of mixed encodings, each read in its own, with the encoding as a last column ``_encoding``."""
    of = encodings(spark, paths, other)
    rows = spark.createDataFrame([], f"{schema}, _encoding string")
    for name in ("UTF-8", other):
        if own := sorted(p for p, e in of.items() if e == name):
            rows = rows.unionByName(csv(spark, own, schema, name, sep, header).withColumn("_encoding", F.lit(name)))
    return rows


def registry(spark: SparkSession, folder: str, encoding: str = "UTF-8") -> dict[str, DataFrame]:
    """enterprise, denomination, address and establishment below ``folder``."""
    kinds = {"enterprise": schemas.ENTERPRISE, "denomination": schemas.DENOMINATION, "address": schemas.ADDRESS, "establishment": schemas.ESTABLISHMENT}
    return {name: csv(spark, f"{folder}/{name}.csv", schema, encoding) for name, schema in kinds.items()}


def without_public(denominations: DataFrame) -> DataFrame:
    """Denominations without those of public entities, as the filtered extract has them."""
    return denominations.filter(~ids.is_public_entity(F.col("EntityNumber")))


def chosen(rows: DataFrame, **allowed: list[str] | None) -> DataFrame:
    """Rows whose columns have one of the allowed values (trimmed): types of denominations or addresses, languages. None or an
    empty list allows all."""
    for column, values in allowed.items():
        if values:
            rows = rows.filter(F.trim(F.coalesce(F.col(column), F.lit(""))).isin(*values))
    return rows


def enterprise_numbers(*tables: DataFrame) -> DataFrame:
    """Each number (bce) of the registry tables' first columns once, as digits; nine get a leading zero."""
    ten = lambda c: F.coalesce(ids.enterprise_number(c), ids.digits(c))
    numbers = [t.select(ten(F.col(t.columns[0])).alias("bce")) for t in tables]
    out = numbers[0]
    for more in numbers[1:]:
        out = out.unionByName(more)
    return out.filter("bce is not null and bce <> ''").distinct()


def streets(names: DataFrame, column: str, seq: str) -> DataFrame:
    """Distinct street names (id, name, label): the first spelling of a normalised name is the label."""
    norm = text.loose(F.col(column))
    rows = names.filter(norm != "").groupBy(norm.alias("name")).agg(F.min_by(column, seq).alias("label"))
    return rows.select(F.xxhash64("name").alias("id"), "name", "label")


def numbered(rows: DataFrame, order: str, id: str = "id", partitions: int | None = None) -> DataFrame:
    """``rows`` with dense ids from 1 in the order of a unique column, without a sort in one task: ranges are numbered by
    themselves, stored, and moved on by what the ranges before them hold (a row for each range)."""
    spark, path = rows.sparkSession, shared_dir(rows.sparkSession, "numbered")
    ranged = rows.repartitionByRange(*([partitions] if partitions else []), order).sortWithinPartitions(order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranged.withColumns({"_range": F.spark_partition_id(), "_place": place}).write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("_range").agg(F.max("_place").alias("n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    moves = sizes.select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return stored.join(moves, "_range").select((F.col("_place") + F.col("_before")).alias(id), *rows.columns)


def street_index(names: DataFrame, column: str, seq: str) -> DataFrame:
    """Distinct street names (id, name, label) with dense ids in the order of names."""
    return numbered(streets(names, column, seq).drop("id"), "name")


def newest_queue(spark: SparkSession, folder: str, first: int | None = None) -> DataFrame:
    """The work queue of the newest log of each kind below a folder."""
    paths = [r["path"] for r in newest(listed(spark, folder, "*.log")).collect()]
    return work_queue(spark, paths, first) if paths else spark.createDataFrame([], "doc_id string, bces array<string>")


def work_queue(spark: SparkSession, paths, first: int | None = None) -> DataFrame:
    """(doc_id, bces) of log lines that name a document and an enterprise; ``first`` documents only, by id."""
    line = F.col("value")
    doc = F.regexp_extract(line, r"DOC=([a-f0-9]{64})", 1)
    number = F.regexp_extract(line, r"DOC=[a-f0-9]{64}.*?(?:BCE|TVA)[^\d]*([\d.]{9,})", 1)
    rows = spark.read.text(paths).select(doc.alias("doc_id"), number.alias("bce")).filter("doc_id <> '' and bce <> ''")
    out = rows.groupBy("doc_id").agg(F.sort_array(F.collect_list("bce")).alias("bces"))
    return out.orderBy("doc_id").limit(first) if first else out


def prefer(first: DataFrame, second: DataFrame, key: str, value: str) -> DataFrame:
    """Lookups of the first source, of the second where the first has nothing, and which keys neither has."""
    a, b = first.alias("a"), second.alias("b")
    rows = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    got = F.coalesce(F.when(F.size(F.col(f"a.{value}")) > 0, F.col(f"a.{value}")), F.when(F.size(F.col(f"b.{value}")) > 0, F.col(f"b.{value}")))
    return rows.select(F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key), got.alias(value), got.isNull().alias("unresolved"))
