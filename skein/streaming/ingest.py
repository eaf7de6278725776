"""Ingest in micro-batches: unseen items become sources and claims; ids go on from what is stored."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import claims as C
from ..operators import similarity as S
from ..operators import tables as T
from ..operators.durable import kept
from ..sources import jsonl


def pair_tasks(new: DataFrame, stored: DataFrame) -> DataFrame:
    """a, b, sim, kind of pairs of new claims with new or stored ones of other sources. Fragments wait for refinement;
    stored claims may be retired."""
    fit = lambda df: df.where(~C.T.needs_refining(F.col("text"))).select("id", F.col("source_id").alias("source"), "text", *[c for c in ("vec",) if c in df.columns])
    fresh = fit(new)
    found = S.pairs(fresh, fit(stored).unionByName(fresh))
    return found.withColumn("kind", S.pair_kind(F.col("sim")))


def ingest_batch(spark: SparkSession, items: DataFrame, root: str, run_id: str, since: str = "", warnings: tuple[str, ...] = (), feeds_polled: int | None = None) -> dict:
    """One run: items (feed, item_key, url, title, author, published, text, content_sha256) that no source names yet.
    Claims, then tasks, then sources are written, each to the run's own folder, and the run's summary last; a run that is
    tried again reads what other runs have written and replaces its own. Of items with one key the first by url and
    digest counts. Returns the summary. One writer at a time."""
    other = {t: jsonl.without(jsonl.read(spark, f"{root}/{t}", t), run_id) for t in ("sources", "claims", "tasks")}
    one = T.keep_first(T.unseen(items, T.seen_keys(other["sources"])), ["feed", "item_key"], "content_sha256")
    fresh = kept(one.withColumn("source_id", F.concat_ws("_", F.lit("src"), "feed", "item_key")))
    found = C.claim_rows(fresh, keep=("feed", "item_key", "source_id"))
    ids = kept(T.assign_ids(found, other["claims"], "clm", ["feed", "item_key", "para", "sent", "clause"]))
    new = ids.select("id", "source_id", "text", "type", "support_in_text", "quote", F.lit(run_id).alias("run_id"), F.lit("extracted").alias("status"), F.lit(None).cast("string").alias("refines_claim"))
    rough = ids.where(C.T.needs_refining(F.col("text"))).select(F.lit(0).alias("phase"), F.lit("refine").alias("kind"), F.col("id").alias("claim_id"), *[F.lit(None).cast("string").alias(c) for c in ("a", "b")], F.lit(None).cast("double").alias("sim"))
    pairs = pair_tasks(new, other["claims"]).select(F.lit(1).alias("phase"), "kind", F.lit(None).cast("string").alias("claim_id"), "a", "b", "sim")
    payload = F.struct("claim_id", "a", "b", "sim", *[F.lit(None).cast("string").alias(c) for c in ("relation", "edge_judge")])
    numbered = T.assign_ids(rough.unionByName(pairs).withColumn("first", F.coalesce("claim_id", "a")), other["tasks"], "task", ["phase", "first", "b"])
    queue = kept(numbered.select("id", "kind", payload.alias("payload"), F.lit(run_id).alias("created_run"), F.lit("pending").alias("status")))
    counts = ids.groupBy("source_id").agg(F.count("*").alias("claim_count"))
    rows = fresh.join(counts, "source_id", "left").select(F.col("source_id").alias("id"), "feed", "url", "title", "author", "published", "content_sha256", F.coalesce("claim_count", F.lit(0)).alias("claim_count"), F.lit(run_id).alias("run_id"))
    queued = {r["kind"]: r["count"] for r in queue.groupBy("kind").count().collect()}  # three kinds at most
    seen, taken = items.count(), fresh.count()
    summary = {
        "run_id": run_id, "since": since, "feeds_polled": items.select("feed").distinct().count() if feeds_polled is None else feeds_polled, "items_seen": seen, "items_new": taken, "items_skipped": seen - taken,
        "claims_extracted": ids.count(), "tasks_enqueued": {"refine": queued.get("refine", 0), "identity_edge": queued.get("identity", 0) + queued.get("edge", 0)}, "warnings": list(warnings),
    }
    jsonl.append(new, f"{root}/claims", "claims", run_id)
    jsonl.append(queue, f"{root}/tasks", "tasks", run_id)
    jsonl.append(rows, f"{root}/sources", "sources", run_id)
    spark.createDataFrame([(json.dumps(summary, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/runs/{run_id}.json")
    return summary


def ingest_stream(spark: SparkSession, items: DataFrame, root: str, checkpoint: str, run_prefix: str = "run"):
    """A streaming source of items, all that is there now, batch by batch."""
    return items.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: ingest_batch(spark, df, root, f"{run_prefix}-{n:06d}") and None).start()
