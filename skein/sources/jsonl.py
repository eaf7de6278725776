"""JSON-lines tables with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "sources": "id string, feed string, url string, title string, author string, published string, content_sha256 string, claim_count bigint, run_id string",
    "claims": "id string, source_id string, text string, type string, support_in_text double, quote string, run_id string, status string, refines_claim string",
    "edges": "a string, b string, relation string, confidence double, note string, judge string, verified boolean, verifier string, run_id string",
    "tasks": "id string, kind string, payload struct<claim_id:string,a:string,b:string,sim:double,relation:string,edge_judge:string>, created_run string, status string",
}


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table; none of its rows if the path doesn't exist. A malformed line is an error."""
    schema = SCHEMAS[table]
    return spark.read.schema(schema).option("mode", "FAILFAST").option("recursiveFileLookup", "true").json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def append(rows: DataFrame, path: str, table: str, batch: str | None = None) -> None:
    """Fields without value are left out. Texts of items must never come here. A batch has a folder of its own, which a
    second try of the same batch replaces."""
    wanted = rows.sparkSession.createDataFrame([], SCHEMAS[table]).schema.names
    if extra := set(rows.columns) - set(wanted):
        raise ValueError(f"{table} has no column {', '.join(sorted(extra))}")
    out = rows.write.option("ignoreNullFields", "true")
    out.mode("overwrite").json(f"{path}/batch={batch}") if batch else out.mode("append").json(path)


def without(table: DataFrame, batch: str) -> DataFrame:
    """The rows that other runs have written."""
    return table.where(~F.col("run_id" if "run_id" in table.columns else "created_run").eqNullSafe(batch))


SIGNAL = "id string, direction_id string, factor_id string, polarity string, credence double, strength double, relevance double, extraction_confidence double, evidence_quality double, source_weight double, dependency_key string, proposition_id string, source_id string"
#: What a signal's field is when it is left out, and the fields that are shares.
SIGNAL_DEFAULTS = {"polarity": "supports", "credence": 0.5, "strength": 0.5, "relevance": 1.0, "extraction_confidence": 0.5, "evidence_quality": 0.5, "source_weight": 1.0}
SHARES = ("credence", "strength", "relevance", "extraction_confidence", "evidence_quality")


def read_signals(spark: SparkSession, path: str) -> DataFrame:
    """Signals of a JSON-lines file; empty lines are passed over. A row that can't be read, has no id, direction or factor,
    or a share outside 0 to 1 is an error that shows the line."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", SIGNAL + ", broken string", {"columnNameOfCorruptRecord": "broken"}).alias("s")).select("value", "s.*")
    parsed = parsed.withColumns({k: F.coalesce(k, F.lit(v)) for k, v in SIGNAL_DEFAULTS.items()})
    faults = [F.when(F.col("broken").isNotNull(), "not readable"), *[F.when(F.trim(F.coalesce(c, F.lit(""))) == "", f"no {c}") for c in ("id", "direction_id", "factor_id")], *[F.when(~F.col(c).between(0, 1), f"{c} outside 0 to 1") for c in SHARES]]
    fault = F.coalesce(*faults, F.when(F.col("source_weight") < 0, "negative source_weight"), F.when(~F.col("polarity").isin("supports", "weakens"), "unknown polarity"))
    checked = F.when(fault.isNotNull(), F.raise_error(F.concat(F.lit("invalid signal ("), fault, F.lit("): "), F.col("value")))).otherwise(F.col("id"))
    names = spark.createDataFrame([], SIGNAL).columns
    return parsed.withColumn("id", checked.cast("string")).select(*names)


def write_signals(signals: DataFrame, path: str) -> None:
    signals.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
