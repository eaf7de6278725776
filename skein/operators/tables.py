"""Tables of the claim graph: ids, deduplication, queue, edges and their protocol."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import kept

def numeric_suffix(id_: Column, prefix: str) -> Column:
    return F.expr(f"try_cast(regexp_extract({_sql(id_)}, '^{prefix}_([0-9]+)$', 1) as bigint)") if isinstance(id_, str) else F.regexp_extract(id_, f"^{prefix}_([0-9]+)$", 1).try_cast("bigint")


def _sql(name: str) -> str:
    return f"`{name}`"


def last_number(table: DataFrame, prefix: str) -> DataFrame:
    """One row, `last`: the largest number of the ids, 0 if none conforms."""
    return table.agg(F.coalesce(F.max(numeric_suffix(F.col("id"), prefix)), F.lit(0)).alias("last"))


def numbered(rows: DataFrame, order: list[str], column: str = "n") -> DataFrame:
    """rows with 1, 2, ... in the order given. Rows are dealt by range once and kept, as another reading could draw other
    bounds; each range's count, summed over those before, is the offset of its own numbers, so that no task sees all."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = kept(rows.repartitionByRange(tasks, *order).withColumn("part_", F.spark_partition_id()))
    counts = dealt.groupBy("part_").agg(F.count("*").alias("held_"))
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    base = counts.select("part_", F.coalesce(F.sum("held_").over(before), F.lit(0)).alias("base_"))
    inside = F.row_number().over(Window.partitionBy("part_").orderBy(*order))
    return dealt.withColumn("in_", inside).join(F.broadcast(base), "part_").withColumn(column, F.col("base_") + F.col("in_")).drop("part_", "in_", "base_")


def assign_ids(rows: DataFrame, existing: DataFrame, prefix: str, order: list[str]) -> DataFrame:
    """rows with an id that goes on from the largest existing one."""
    last = last_number(existing, prefix)
    return numbered(rows, order).crossJoin(F.broadcast(last)).withColumn("id", F.format_string(f"{prefix}_%06d", F.col("n") + F.col("last"))).drop("n", "last")


def unseen(items: DataFrame, seen: DataFrame) -> DataFrame:
    return items.join(seen.select("feed", "item_key").distinct(), ["feed", "item_key"], "left_anti")


def seen_keys(sources: DataFrame) -> DataFrame:
    start = F.length(F.concat(F.lit("src_"), F.col("feed"), F.lit("_"))) + 1
    return sources.select("feed", F.substring("id", start, F.length("id")).alias("item_key"))


def recent(items: DataFrame, since: str) -> DataFrame:
    return items.where(F.col("published") >= since)


def limited(items: DataFrame, limits: DataFrame, order: str = "position") -> DataFrame:
    """The first rows of each feed in document order; before any filter by date."""
    place = F.row_number().over(Window.partitionBy("feed").orderBy(order))
    return items.withColumn("place_", place).join(F.broadcast(limits), "feed").where(F.col("place_") <= F.greatest(F.lit(0), F.col("limit"))).drop("place_", "limit")


def active(claims: DataFrame) -> DataFrame:
    return claims.where(~F.col("status").eqNullSafe("retired"))


def keep_first(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*key).orderBy(order))
    return rows.withColumn("place_", place).where(F.col("place_") == 1).drop("place_")


def keep_last(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.col(order).desc()))
    return rows.withColumn("place_", place).where(F.col("place_") == 1).drop("place_")


def pending_by_kind(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("status") == "pending").groupBy(F.coalesce("kind", F.lit("unknown")).alias("kind")).agg(F.count("*").alias("pending"))


def latest_run(*tables: DataFrame) -> DataFrame:
    """The last run_id in binary order, not by time."""
    runs = reduce(lambda a, b: a.unionByName(b), [t.select("run_id") for t in tables])
    return runs.agg(F.coalesce(F.max(F.nullif(F.col("run_id"), F.lit(""))), F.lit("unknown")).alias("run_id"))


def take_batch(tasks: DataFrame, kind: str, most: int = 50) -> DataFrame:
    return tasks.where((F.col("status") == "pending") & (F.col("kind") == kind)).orderBy("id").limit(most)


def normalised_edges(edges: DataFrame) -> DataFrame:
    """Relations without direction name their smaller end first."""
    free = F.col("relation").isin("same", "contradicts")
    return edges.withColumns({"a": F.when(free, F.least("a", "b")).otherwise(F.col("a")), "b": F.when(free, F.greatest("a", "b")).otherwise(F.col("b"))})


def upsert_edges(edges: DataFrame, judged: DataFrame) -> DataFrame:
    """Edges by (a, b, relation): a new judgment replaces the old; `unrelated` stores none."""
    old = edges.withColumn("turn_", F.lit(0))
    new = judged.where(F.col("relation") != "unrelated").withColumn("turn_", F.lit(1))
    return keep_last(normalised_edges(old.unionByName(new, allowMissingColumns=True)), ["a", "b", "relation"], "turn_").drop("turn_")


def to_verify(judged: DataFrame) -> DataFrame:
    """Payloads of verify tasks for new contradictions and identities."""
    return normalised_edges(judged).where(F.col("relation").isin("contradicts", "same")).select("a", "b", "relation", F.col("judge").alias("edge_judge"))


def may_verify(verifier: Column, judge: Column) -> Column:
    """Another model family than the judge's."""
    return F.substring_index(verifier, "-", 1) != F.substring_index(judge, "-", 1)


def finish_tasks(tasks: DataFrame, done: DataFrame) -> DataFrame:
    """Status of the tasks in done (id, result) becomes result."""
    return tasks.join(done.select("id", F.col("result").alias("result_")), "id", "left").withColumn("status", F.coalesce("result_", "status")).drop("result_").select(*tasks.columns)


def refine(claims: DataFrame, refined: DataFrame) -> DataFrame:
    """Refined claims (with refines_claim) join the table; what they refine retires."""
    gone = refined.select(F.col("refines_claim").alias("id")).distinct().withColumn("gone_", F.lit(True))
    kept = claims.join(gone, "id", "left").withColumn("status", F.when(F.col("gone_"), "retired").otherwise(F.col("status"))).drop("gone_")
    return kept.unionByName(refined.withColumn("status", F.lit("refined")), allowMissingColumns=True)


def apply_verification(edges: DataFrame, verdicts: DataFrame) -> DataFrame:
    """verdicts (a, b, relation, verdict, verifier): confirm marks, a relation's name relabels, remove drops."""
    x = edges.join(verdicts.select("a", "b", "relation", "verdict", F.col("verifier").alias("by_")), ["a", "b", "relation"], "left").where(~F.col("verdict").eqNullSafe("remove"))
    new = F.when(F.col("verdict").isNull() | (F.col("verdict") == "confirm"), F.col("relation")).otherwise(F.col("verdict"))
    return x.withColumn("verified", F.col("verdict").isNotNull() | F.coalesce("verified", F.lit(False))).withColumn("verifier", F.coalesce("by_", "verifier")).withColumn("relation", new).select(*edges.columns)


def missing_refine_tasks(fragments: DataFrame, tasks: DataFrame) -> DataFrame:
    has = tasks.where(F.col("kind") == "refine").select(F.col("payload.claim_id").alias("id"))
    return fragments.join(has, "id", "left_anti")
