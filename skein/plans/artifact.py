"""The compiled artifact, the map and their reports; only small, finished tables come to the driver."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import atlas as A
from ..operators import tables as G


def compiled(sources: DataFrame, claims: DataFrame, edges: DataFrame, tasks: DataFrame) -> dict:
    """Counts of the tables, pending work by kind and the latest run."""
    now = G.active(claims)
    return {
        "generated_run": G.latest_run(sources, claims, edges).first()[0],
        "counts": {"sources": sources.count(), "claims": now.count(), "edges": edges.count(), "verified": edges.where(F.coalesce("verified", F.lit(False))).count()},
        "pending": {r["kind"]: r["pending"] for r in G.pending_by_kind(tasks).orderBy("kind").collect()},
    }


def atlas(claims: DataFrame, sources: DataFrame, edges: DataFrame, vectors: DataFrame | None = None, names: DataFrame | None = None, persisted: list[dict] | None = None, run_id: str = "unknown") -> dict[str, DataFrame]:
    """The map's tables: dots, districts, tensions, bounds, fault. vectors (id, vec), or districts by feed without any."""
    now = G.active(claims)
    if vectors is not None:
        placed = A.assign(now.join(vectors, "id"), persisted, run_id)
        anchors = placed.groupBy(F.col("district").alias("id")).agg(F.first("ax").alias("x"), F.first("ay").alias("y"))
        assigned = placed.select("id", "district")
    else:
        assigned = A.assign_by_feed(A.claim_feeds(now, sources)).select("id", "district")
        places, spots = A._Places([]), []
        for r in assigned.select("district").distinct().orderBy("district").collect():  # one a feed
            spots.append((r[0], *places.spiral()))
        anchors = claims.sparkSession.createDataFrame(spots, "id string, x double, y double")
    dots = A.dots(assigned, anchors)
    found = A.districts(assigned, edges).join(anchors.select(F.col("id").alias("district"), "x", "y"), "district")
    texts = assigned.join(now.select("id", "text"), "id")
    found = found.join(A.labels(texts), "district", "left")
    found = A.named(found, names if names is not None else claims.sparkSession.createDataFrame([], "district string, name string"))
    tense = A.tensions(edges, now)
    found = found.join(A.district_tensions(tense, assigned), "district", "left").withColumn("tensions", F.coalesce("tensions", F.lit(0)))
    return {"dots": dots, "districts": found, "tensions": tense, "bounds": A.bounds(dots, found), "fault": A.sharpest_fault(edges)}


def ranking_report(ranks: DataFrame, cruxes: DataFrame) -> str:
    """A ranking as Markdown."""
    lines = []
    for scope in [r[0] for r in ranks.select("scope").distinct().orderBy("scope").collect()]:
        lines += [f"## {scope}", "", "| rank | direction | score | robust | status |", "|-|-|-|-|-|"]
        lines += [f"| {r['rank']} | {r['direction_name']} | {r['score']:.3f} | {r['robust_score']:.3f} | {r['status']} |" for r in ranks.where(F.col("scope") == scope).orderBy("rank").collect()]
        lines += ["", *[f"- {r['factor_name']}: {r['delta']:+.3f}, value of information {r['voi']:.3f}" for r in cruxes.where(F.col("scope") == scope).orderBy("place").collect()], ""]
    return "\n".join(lines)


def decision_artifact(ranks: DataFrame, gaps: DataFrame, cruxes: DataFrame) -> str:
    """Rankings by scope as JSON, with what no evidence was found for marked."""
    status = F.when(F.col("evidence_count") == 0, "unevaluated").otherwise(F.col("status"))
    rows = [r.asDict() for r in ranks.select("scope", "direction_id", F.bround("score", 3).alias("score"), F.bround("robust_score", 3).alias("robust"), status.alias("status"), "rank", "evidence_count").orderBy("scope", "rank").collect()]
    return json.dumps({"directions": rows, "leaders": [r.asDict() for r in gaps.orderBy("scope").collect()], "cruxes": [r.asDict() for r in cruxes.where(F.col("place") <= 6).orderBy("scope", "place").collect()]}, ensure_ascii=False)
