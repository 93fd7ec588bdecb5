"""Files read and written with fixed schemas."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

JOB_FIELDS = (
    "area seniority title company location workplace_type workplace_declared published_date url description"
    " source external_id search_term skills area_score area_matches regiao polo"
).split()
JOBS = ", ".join(f"{c} string" for c in JOB_FIELDS)


def read_csv(spark: SparkSession, path: str, schema: str = JOBS) -> DataFrame:
    """CSV with a header, quoted line ends and an optional byte order mark; columns by the schema, never inferred."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")
    raw = reader.option("enforceSchema", False).csv(path)
    names = {c.lstrip("﻿"): c for c in raw.columns}
    wanted = spark.createDataFrame([], schema).schema
    return raw.select(*[(F.col(f"`{names[f.name]}`").cast(f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted])


def latest(spark: SparkSession, folder: str, pattern: str = "*.csv") -> str | None:
    """The file of a folder that comes last by name."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return max((str(f.getPath()) for f in found or []), default=None)


def read_parquet(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Parquet that must have the required columns."""
    df = spark.read.parquet(path)
    if missing := sorted(set(required) - set(df.columns)):
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return df


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """A source checkpoint: the header must be the fields, skills a JSON list, flags and scores well formed.

    Rows that repeat an identity must be equal. Everything is checked in one aggregate.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if [c.lstrip("﻿") for c in raw.columns] != JOB_FIELDS:
        raise ValueError("the checkpoint's header is not the list of fields")
    raw = raw.toDF(*JOB_FIELDS)
    flag, score, skills = F.lower("workplace_declared"), F.col("area_score").try_cast("double"), F.from_json("skills", "array<string>")
    bad = raw.agg(
        F.count(F.when(F.coalesce("source", F.lit("")) == "", 1)).alias("source"), F.count(F.when(F.coalesce("external_id", F.lit("")) == "", 1)).alias("external_id"),
        F.count(F.when(~flag.isin("true", "false"), 1)).alias("workplace_declared"), F.count(F.when(score.isNull() & (F.coalesce("area_score", F.lit("")) != ""), 1)).alias("area_score"),
        F.count(F.when(skills.isNull() & (F.coalesce("skills", F.lit("")) != ""), 1)).alias("skills"),
    ).first()
    if broken := [k for k, v in bad.asDict().items() if v]:
        raise ValueError(f"malformed in the checkpoint: {', '.join(broken)}")
    if not raw.distinct().groupBy("source", "external_id").count().filter("count > 1").isEmpty():
        raise ValueError("the checkpoint holds two different rows of one posting")
    return raw.distinct().withColumn("workplace_declared", flag == "true").withColumn("area_score", score).withColumn("skills", skills)


def read_metrics(spark: SparkSession, path: str, version: int = 1) -> DataFrame:
    """Run metrics as JSON, of the given schema version."""
    source = "array<struct<source:string,raw_jobs:long,requests:long,errors:array<string>,collection_profile:string>>"
    alert = "array<struct<rule:string,severity:string,message:string,source:string,value:string,limit:string>>"
    schema = f"schema_version int, collected_at timestamp, requested_full_scope boolean, full_scope boolean, failed_sources array<string>, raw_jobs long, eligible_jobs long, requests long, source_stats {source}, alerts {alert}"
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    if not df.filter(F.col("schema_version").isNull() | (F.col("schema_version") != version)).isEmpty():
        raise ValueError(f"metrics of another version than {version}")
    return df


def conserved(summary: DataFrame) -> DataFrame:
    """Rows of an enrichment summary of which the outcomes do not add up to what was selected; there must be none."""
    return summary.filter(F.col("selected") != F.col("enriched") + F.col("closed") + F.col("removed") + F.col("pending"))


def read_rules(path: str) -> dict:
    """A rule file in YAML, or JSON where no YAML library is there."""
    with open(path, encoding="utf-8") as lines:
        try:
            import yaml
        except ImportError:
            return json.load(lines)
        return yaml.safe_load(lines) or {}


def log_counts(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(file, n): the last number that the pattern's group takes from each log."""
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), place, F.regexp_extract("value", pattern, 1).alias("n"))
    return lines.filter("n <> ''").groupBy("file").agg(F.max_by(F.col("n").cast("long"), "place").alias("n"))


def dataset_columns(df: DataFrame, skills: Column) -> DataFrame:
    """The public form of postings: typed columns, skills joined by semicolons, nulls kept."""
    return df.select(
        "source", "external_id", "title", "company", F.array_join(skills, "; ").alias("skills"), "area", "seniority", "workplace_type", "location",
        "regiao", "polo", F.col("published_date").cast("date").alias("published_date"), "description", "url", "search_term", F.col("enrich_encerrada").cast("boolean").alias("enrich_encerrada"),
    )


def write_dataset(df: DataFrame, path: str, order: str = "id") -> None:
    """Parquet in the order of ids; the commit protocol makes the replacement atomic."""
    df.repartitionByRange(order).sortWithinPartitions(order).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, order: list[str], files: int | None = None) -> None:
    """CSV with a header in the given order; one file only where a report asks for it."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order) if files is None else df.orderBy(*order).coalesce(files)
    out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_payload(df: DataFrame, path: str) -> None:
    """Rows as JSON lines."""
    df.write.mode("overwrite").json(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder that all machines share and read again, for what is read several times."""
    spark = df.sparkSession
    at = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{at.rstrip('/')}/quillwort/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def snapshot_manifest(df: DataFrame, path: str, parent: str | None, name: str) -> dict:
    """Write a snapshot and describe it: its id, that of its parent, and a hash of its rows that ignores order."""
    df.write.mode("errorifexists").parquet(path)
    rows, mark = df.sparkSession.read.parquet(path).agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)"))).first()
    digest = hashlib.sha256(f"{rows}:{mark}".encode()).hexdigest()
    return {"schema_version": 1, "snapshot_id": name, "parent": parent, "rows": rows, "digest": digest, "columns": df.columns}


def check_parent(manifest: dict, current: str | None) -> None:
    """A snapshot may only follow the one it was made from."""
    if manifest.get("parent") != current:
        raise ValueError("another snapshot has been published since this one was begun")


def evolve(df: DataFrame, schema: StructType, defaults: dict[str, object]) -> DataFrame:
    """``df`` in a newer schema: missing columns get their default, columns the schema does not know are refused."""
    if unknown := sorted(set(df.columns) - set(schema.names)):
        raise ValueError(f"columns of a newer version: {', '.join(unknown)}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name) for f in schema])


def report_markdown(title: str, sections: dict[str, DataFrame], limit: int = 200) -> str:
    """Tables of small aggregates as Markdown; a section of more rows than ``limit`` is an error, not cut off."""
    out = [f"# {title}", ""]
    for name, df in sections.items():
        rows = df.take(limit + 1)
        if len(rows) > limit:
            raise ValueError(f"{name} is no report table: it has more than {limit} rows")
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows] + [""]
    return "\n".join(out)
