"""The map of claims: clusters in the order of ids, their places, labels, tensions and bounds."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens

#: Fixed values of the map.
JOIN, NEAR = 0.32, 0.18
APART, STEP, TURN, ANGLES = 150.0, 170.0, 2.39996, 12
BASE, GROWTH, CAP, PAD = 40.0, 14.0, 170.0, 6.0
ANCHOR = "id string, label string, centroid array<double>, x double, y double, created_run string, feed string, ordinal long"


def fraction(id_: Column, place: int) -> Column:
    """The place-th 8 bytes of the id's digest, as a share of 2^64."""
    return F.conv(F.substring(F.sha2(id_.cast("binary"), 256), 16 * place + 1, 16), 16, 10).cast("double") / 2.0**64


def radius(n: Column) -> Column:
    return F.least(F.lit(BASE) + GROWTH * F.sqrt(n), F.lit(CAP))


def jitter(id_: Column, index: Column) -> tuple[Column, Column]:
    """A claim's offset in its district, by the disc's size when it joined as number `index`."""
    far = F.sqrt(fraction(id_, 1)) * F.greatest(radius(index) - PAD, F.lit(0.0))
    turn = fraction(id_, 0) * (2 * math.pi)
    return far * F.cos(turn), far * F.sin(turn)


def dots(assigned: DataFrame, anchors: DataFrame) -> DataFrame:
    """Claims (id, district) with join index and place."""
    order = Window.partitionBy("district").orderBy("id")
    x = assigned.withColumn("joined", F.row_number().over(order)).join(anchors.select(F.col("id").alias("district"), F.col("x").alias("ax"), F.col("y").alias("ay")), "district")
    dx, dy = jitter(F.col("id"), F.col("joined"))
    return x.withColumn("x", F.bround(F.col("ax") + dx, 2)).withColumn("y", F.bround(F.col("ay") + dy, 2)).drop("ax", "ay")


def lit_ids(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()


def tensions(edges: DataFrame, active: DataFrame) -> DataFrame:
    ids = active.select("id")
    found = edges.where(F.col("relation") == "contradicts")
    return found.join(ids.withColumnRenamed("id", "a"), "a", "left_semi").join(ids.withColumnRenamed("id", "b"), "b", "left_semi").select("a", "b", F.left(F.coalesce("note", F.lit("")), F.lit(140)).alias("note"), F.coalesce("verified", F.lit(False)).alias("verified"), "confidence")


def district_tensions(found: DataFrame, assigned: DataFrame) -> DataFrame:
    """Tensions of a district; one within it counts once."""
    of = lambda end: assigned.select(F.col("id").alias(end), F.col("district").alias(f"d{end}"))
    both = found.join(of("a"), "a").join(of("b"), "b")
    return both.select(F.explode(F.array_distinct(F.array("da", "db"))).alias("district")).groupBy("district").agg(F.count("*").alias("tensions"))


def districts(assigned: DataFrame, edges: DataFrame, least: int = 2) -> DataFrame:
    """claims, lit, dim and radius of districts of at least two members."""
    marked = assigned.join(lit_ids(edges).withColumn("hit", F.lit(True)), "id", "left")
    sums = marked.groupBy("district").agg(F.count("*").alias("claims"), F.count_if(F.coalesce("hit", F.lit(False))).alias("lit"))
    return sums.where(F.col("claims") >= least).select("district", "claims", "lit", (F.col("claims") - F.col("lit")).alias("dim"), F.bround(radius(F.col("claims")), 2).alias("r"))


def labels(texts: DataFrame, key: str = "district", most: int = 3) -> DataFrame:
    """The tokens that mark a district most: counts times log(1 + all tokens / the token's count)."""
    each = texts.select(key, F.explode(tokens(F.col("text"))).alias("token"))
    own = each.groupBy(key, "token").agg(F.count("*").alias("n"))
    everywhere = own.groupBy("token").agg(F.sum("n").alias("g"))
    total = everywhere.agg(F.sum("g").alias("total"))
    scored = own.join(everywhere, "token").crossJoin(F.broadcast(total)).withColumn("score", F.col("n") * F.log1p(F.col("total") / F.col("g")))
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), "token")
    top = scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    return top.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "token"))), lambda t: t["token"]), " · ").alias("label"))


def named(found: DataFrame, names: DataFrame) -> DataFrame:
    """Human names (district, name) go before labels; empty ones don't."""
    x = found.join(names.select("district", "name"), "district", "left")
    return x.withColumn("label", F.coalesce(F.nullif(F.col("name"), F.lit("")), F.nullif(F.col("label"), F.lit("")), F.col("district"))).drop("name")


def bounds(points: DataFrame, discs: DataFrame) -> DataFrame:
    """The box of all dots and discs with a margin of a twentieth of its longer side, 50 if it has none."""
    ends = points.select(F.col("x").alias("x0"), F.col("x").alias("x1"), F.col("y").alias("y0"), F.col("y").alias("y1"))
    ends = ends.unionByName(discs.select((F.col("x") - F.col("r")).alias("x0"), (F.col("x") + F.col("r")).alias("x1"), (F.col("y") - F.col("r")).alias("y0"), (F.col("y") + F.col("r")).alias("y1")))
    b = ends.agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    span = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    pad = F.when(span > 0, span * 0.05).otherwise(50.0)
    some = F.col("x0").isNotNull()
    edge = lambda c, sign, else_: F.when(some, F.bround(F.col(c) + sign * pad, 2)).otherwise(else_)
    return b.select(edge("x0", -1, 0.0).alias("min_x"), edge("x1", 1, 1000.0).alias("max_x"), edge("y0", -1, 0.0).alias("min_y"), edge("y1", 1, 1000.0).alias("max_y"))


def sharpest_fault(edges: DataFrame) -> DataFrame:
    top = F.max_by(F.struct("a", "b", "confidence", "note"), F.struct("confidence", "a", "b"))
    return edges.where(F.coalesce("verified", F.lit(False))).agg(top.alias("t")).where(F.col("t").isNotNull()).select("t.*")


def fault_ends(fault: DataFrame, claims: DataFrame, sources: DataFrame) -> DataFrame:
    """The fault with the text (140 characters) and the source's url of either end."""
    ends = claims.join(sources.select(F.col("id").alias("source_id"), "url"), "source_id", "left").select("id", F.substring("text", 1, 140).alias("text"), F.col("url").alias("src"))
    of = lambda k: ends.select(F.col("id").alias(k), F.col("text").alias(f"text_{k}"), F.col("src").alias(f"src_{k}"))
    return fault.join(of("a"), "a").join(of("b"), "b")


def claim_feeds(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """A claim's feed: its source's (of several records the one of the last run), else the part of source_id after src_,
    else unknown."""
    last = sources.groupBy(F.col("id").alias("source_id")).agg(F.max_by("feed", F.struct("run_id", "feed") if "run_id" in sources.columns else F.col("feed")).alias("feed"))
    guess = F.nullif(F.regexp_extract(F.coalesce("source_id", F.lit("")), "^src_([^_]+)", 1), F.lit(""))
    return claims.join(last, "source_id", "left").withColumn("feed", F.coalesce(F.nullif(F.col("feed"), F.lit("")), guess, F.lit("unknown")))


class _Places:
    """Places that are taken; new ones are clear of all."""

    def __init__(self, taken: list[tuple[float, float]]):
        self.taken, self.slot = list(taken), 0

    def clear(self, x: float, y: float) -> bool:
        return all((x - p) ** 2 + (y - q) ** 2 >= APART**2 for p, q in self.taken)

    def spiral(self) -> tuple[float, float]:
        while True:
            r, t = STEP * math.sqrt(self.slot), TURN * self.slot
            self.slot += 1
            if self.clear(p := round(r * math.cos(t), 2), q := round(r * math.sin(t), 2)):
                self.taken.append((p, q))
                return p, q

    def orbit(self, id_: str, x: float, y: float) -> tuple[float, float]:
        first = int.from_bytes(hashlib.sha256(id_.encode()).digest()[:8], "big") / 2.0**64 * 2 * math.pi
        ring = 0
        while True:
            ring += 1
            for k in range(ANGLES):
                t = first + k * 2 * math.pi / ANGLES
                if self.clear(p := round(x + STEP * ring * math.cos(t), 2), q := round(y + STEP * ring * math.sin(t), 2)):
                    self.taken.append((p, q))
                    return p, q


def replay(claims: pd.DataFrame, persisted: list[dict], run_id: str) -> pd.DataFrame:
    """Claims (id, vec) in order of id, each to the nearest visible anchor or to the next one in order of creation, and
    else to a new anchor. One row a claim, with its anchor; sequential by definition."""
    places = _Places([(a["x"], a["y"]) for a in persisted])
    locked = [a for a in persisted if a["centroid"]]
    shown: list[dict] = []
    matrix, rows, number = np.zeros((0, 0)), [], len(persisted)
    for id_, vec in claims.sort_values("id")[["id", "vec"]].itertuples(index=False):
        v = np.asarray(vec, np.float64)
        norm = np.linalg.norm(v)
        sims = matrix[: len(shown)] @ v / norm if len(shown) and norm else np.zeros(len(shown))
        best = int(np.argmax(sims)) if len(shown) else -1
        near = float(sims[best]) if len(shown) else -1.0
        if best >= 0 and near >= JOIN:
            anchor = shown[best]
        else:
            if locked:
                anchor = locked.pop(0)
            else:
                x, y = places.orbit(id_, shown[best]["x"], shown[best]["y"]) if near >= NEAR else places.spiral()
                anchor = {"id": f"d_{number + 1:03d}", "centroid": [round(float(c), 4) for c in v], "x": x, "y": y, "created_run": run_id}
                number += 1
            shown.append(anchor)
            c = np.asarray(anchor["centroid"], np.float64)
            if len(shown) > len(matrix):
                matrix = np.vstack([matrix.reshape(-1, len(c)), np.zeros((max(16, len(matrix)), len(c)))])
            n = np.linalg.norm(c)
            matrix[len(shown) - 1] = c / n if n else c
        rows.append((id_, anchor["id"], anchor["x"], anchor["y"], anchor["centroid"], anchor["created_run"]))
    return pd.DataFrame(rows, columns=["id", "district", "ax", "ay", "centroid", "created_run"])


def assign(claims: DataFrame, persisted: list[dict] | None = None, run_id: str = "unknown") -> DataFrame:
    """id, district, ax, ay, centroid, created_run. The replay depends on the order of all claims, so it is one group;
    anchors are as many as topics, and vectors are all that is sent."""
    held = list(persisted or [])
    return claims.select("id", F.col("vec").cast("array<double>").alias("vec")).groupBy().applyInPandas(lambda pdf: replay(pdf, held, run_id), "id string, district string, ax double, ay double, centroid array<double>, created_run string")


def assign_by_feed(claims: DataFrame) -> DataFrame:
    """Without vectors: a district a feed, numbered by name."""
    order = Window.orderBy("feed")
    feeds = claims.select("feed").distinct().withColumn("district", F.format_string("d_%03d", F.row_number().over(order)))
    return claims.join(F.broadcast(feeds), "feed")


def markdown(found: DataFrame, most: int = 25) -> list[str]:
    """Lines of the largest districts with a bar of ten for the share that is lit, and one line for the others."""
    bar = F.bround(10 * F.col("lit") / F.col("claims")).cast("int")
    line = F.concat(F.rpad("label", 32, " "), F.lit(" "), F.repeat(F.lit("#"), bar), F.repeat(F.lit("."), 10 - bar), F.lit(" "), F.lpad(F.col("claims").cast("string"), 5, " "))
    order = F.row_number().over(Window.orderBy(F.col("claims").desc(), "district"))
    x = found.withColumn("line", line).withColumn("place", order)
    top = [r["line"] for r in x.where(F.col("place") <= most).orderBy("place").collect()]
    rest = x.where(F.col("place") > most).agg(F.count("*"), F.sum("claims")).first()
    return [*top, f"... and {rest[0]} smaller districts with {rest[1]} claims"] if rest[0] else top
