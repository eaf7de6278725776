"""Rankings from signals: two-stage capped evidence, factor estimates, scores, statuses, ranks and cruxes.

Signals are aggregated in two shuffles of partial sums; directions, factors and scopes are small configured tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CAP, SATURATION, LEAST_WEIGHT, FLOOR = 3.0, 12.0, 1e-9, 0.02
MISSING_PRIOR = (0.25, 0.5, 0.75, 0.1)
SCOPES = ("self", "humanity", "future")
FACTOR_DDL = "ord int, factor_id string, factor_name string, weight double, cost boolean, geometric boolean, scope_weights map<string,double>, prior struct<low:double,expected:double,high:double,confidence:double>, prior_weight double"
#: Factors with their weights and scope weights.
FACTORS = (
    ("scale", "Scale", 1.40, False, True, {"self": 0.4, "family": 0.5, "humanity": 1.5, "future": 1.8, "sentient": 2.0}),
    ("neglectedness", "Neglectedness", 1.05, False, True, {"humanity": 1.2, "sentient": 1.2}),
    ("tractability", "Tractability", 1.10, False, True, {}),
    ("personal_fit", "Personal fit", 1.00, False, True, {"self": 1.6, "family": 1.3}),
    ("leverage", "Leverage", 1.00, False, True, {}),
    ("career_capital", "Career capital", 0.75, False, False, {"self": 1.3, "family": 1.2}),
    ("downside_risk", "Downside risk", 0.85, True, True, {}),
    ("epistemic_robustness", "Epistemic robustness", 0.65, False, False, {}),
)


def factor_table(spark: SparkSession) -> DataFrame:
    rows = [(k, f, name, w, cost, geo, scopes, MISSING_PRIOR, 1.0) for k, (f, name, w, cost, geo, scopes) in enumerate(FACTORS)]
    return spark.createDataFrame(rows, FACTOR_DDL)


def clamp(x: Column) -> Column:
    """Into 0..1; NaN and null are 0."""
    return F.when(x.isNull() | F.isnan(x), 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), x)))


def ordered(e: Column) -> Column:
    """An estimate whose bounds and expectation are in order: the median is expected."""
    three = F.array_sort(F.array(F.coalesce(e["low"], e["expected"]), e["expected"], F.coalesce(e["high"], e["expected"])))
    return estimate(three[0], three[1], three[2], e["confidence"])


def estimate(low: Column, expected: Column, high: Column, confidence: Column) -> Column:
    return F.struct(low.alias("low"), expected.alias("expected"), high.alias("high"), confidence.alias("confidence"))


def inverted(e: Column) -> Column:
    return estimate(1 - e["high"], 1 - e["expected"], 1 - e["low"], e["confidence"])


def risk_adjusted(e: Column, attitude: str) -> Column:
    if attitude == "risk_averse":
        return clamp(e["expected"] - (e["high"] - e["low"]) * (0.15 + 0.35 * (1 - e["confidence"])))
    if attitude == "risk_seeking":
        return clamp(e["expected"] + F.greatest(F.lit(0.0), e["high"] - e["expected"]) * (0.10 + 0.20 * e["confidence"]))
    return e["expected"]


def signal_weight() -> Column:
    return F.col("source_weight") * F.col("relevance") * F.col("extraction_confidence") * F.col("evidence_quality") * F.greatest(F.lit(0.05), F.col("strength"))


def signal_value() -> Column:
    sign = F.when(F.col("polarity") == "weakens", -1.0).otherwise(1.0)
    return clamp(0.5 + sign * (F.col("credence") - 0.5) * F.col("strength"))


def group_key() -> Column:
    named = [F.nullif(F.col(c), F.lit("")) for c in ("dependency_key", "source_id", "proposition_id")]
    return F.coalesce(*named, F.lit("__ungrouped__"))


def stage_one(signals: DataFrame) -> DataFrame:
    """Sums by direction, factor and dependency group."""
    rated = signals.select("direction_id", "factor_id", group_key().alias("dep"), signal_weight().alias("w"), signal_value().alias("v")).where(F.col("w") >= LEAST_WEIGHT)
    return rated.groupBy("direction_id", "factor_id", "dep").agg(F.sum("w").alias("sw"), (F.sum(F.col("v") * F.col("w")) / F.sum("w")).alias("mean"), F.count("*").alias("n"))


def stage_two(first: DataFrame) -> DataFrame:
    """Evidence by direction and factor; a group weighs CAP at most however many signals it has."""
    w = F.least(F.col("sw"), F.lit(CAP))
    sums = first.groupBy("direction_id", "factor_id").agg(F.sum(w).alias("ew"), F.sum(w * F.col("mean")).alias("s1"), F.sum(w * F.col("mean") * F.col("mean")).alias("s2"), F.count("*").alias("groups"), F.sum("n").alias("evidence_count"))
    mean = F.col("s1") / F.col("ew")
    return sums.select("direction_id", "factor_id", "ew", mean.alias("emean"), F.greatest(F.lit(0.0), F.col("s2") / F.col("ew") - mean * mean).alias("evar"), "groups", "evidence_count")


def unknown_ids(signals: DataFrame, directions: DataFrame, factors: DataFrame) -> DataFrame:
    """kind and id of the directions, and then factors of known directions, that signals name without being configured."""
    lost = signals.join(F.broadcast(directions.select("direction_id")), "direction_id", "left_anti").select(F.lit("direction").alias("kind"), F.col("direction_id").alias("id"))
    known = signals.join(F.broadcast(directions.select("direction_id")), "direction_id", "left_semi")
    other = known.join(F.broadcast(factors.select("factor_id")), "factor_id", "left_anti").select(F.lit("factor").alias("kind"), F.col("factor_id").alias("id"))
    return lost.unionByName(other).distinct()


def factor_scores(evidence: DataFrame, directions: DataFrame, factors: DataFrame, scopes: DataFrame, attitude: str = "neutral") -> DataFrame:
    """A row a scope, direction and factor: estimate, adjusted score and contribution; factors of no weight are left out."""
    cells = scopes.crossJoin(directions).crossJoin(factors)  # configured tables
    weight = F.col("weight") * F.coalesce(F.try_element_at("scope_weights", F.col("scope")), F.lit(1.0))
    c = cells.withColumn("fw", weight).where(F.col("fw") > 0).join(evidence, ["direction_id", "factor_id"], "left")
    prior = ordered(F.col("prior"))
    ew, pc = F.coalesce("ew", F.lit(0.0)), F.col("p.confidence")
    c = c.withColumn("p", prior).withColumn("pw", F.col("prior_weight") * F.greatest(F.lit(0.05), pc))
    total = F.col("pw") + ew
    mean = F.when(total > 0, (F.col("p.expected") * F.col("pw") + F.coalesce("emean", F.lit(0.0)) * ew) / total).otherwise(0.5)
    two = F.when(total > 0, (F.col("p.expected") ** 2 * F.col("pw") + F.coalesce("emean", F.lit(0.0)) ** 2 * ew) / total - mean * mean).otherwise(0.0)
    variance = F.greatest(F.lit(0.0), two, F.coalesce("evar", F.lit(0.0)))
    confidence = clamp(F.greatest(ew / (ew + SATURATION), pc * F.col("pw") / (F.col("pw") + ew + 1e-12)))
    spread = F.least(F.lit(0.95), F.sqrt(variance) + 0.45 * (1 - confidence))
    est = estimate(clamp(mean - spread / 2), clamp(mean), clamp(mean + spread / 2), confidence)
    c = c.withColumn("estimate", ordered(est)).withColumn("scored", F.when(F.col("cost"), ordered(inverted(F.col("estimate")))).otherwise(F.col("estimate")))
    c = c.withColumn("adjusted", clamp(risk_adjusted(F.col("scored"), attitude))).withColumn("robust", clamp(F.col("scored.low")))
    kept = [x for x in ("scope", "direction_id", "direction_name", "dord", "blocked") if x in c.columns]
    return c.select(*kept, "ord", "factor_id", "factor_name", "fw", "geometric", "estimate", "adjusted", "robust", (F.col("fw") * F.col("adjusted")).alias("contribution"), F.coalesce("evidence_count", F.lit(0)).alias("evidence_count"), F.coalesce("ew", F.lit(0.0)).alias("ew"), F.coalesce("groups", F.lit(0)).alias("groups"), F.col("evidence_count").isNull().alias("missing"))


def direction_scores(scores: DataFrame, model: str = "hybrid") -> DataFrame:
    """A row a scope and direction: additive, geometric, hybrid and robust scores. Factors that aren't geometric fold in by
    their mean."""
    by = ["scope", "direction_id", "direction_name", "dord", "blocked"]
    log_ = F.when(F.col("geometric"), F.col("fw") * F.log(F.greatest(F.lit(FLOOR), F.col("adjusted"))))
    agg = scores.groupBy(*by).agg(
        F.sum("fw").alias("w"), F.sum("contribution").alias("c"), F.sum(F.col("fw") * F.col("robust")).alias("r"), F.coalesce(F.sum(log_), F.lit(0.0)).alias("l"),
        F.coalesce(F.sum(F.when(F.col("geometric"), F.col("fw"))), F.lit(0.0)).alias("lw"), F.coalesce(F.sum(F.when(~F.col("geometric"), F.col("contribution"))), F.lit(0.0)).alias("a"),
        F.coalesce(F.sum(F.when(~F.col("geometric"), F.col("fw"))), F.lit(0.0)).alias("aw"), F.sum("evidence_count").alias("evidence_count"), F.sum("ew").alias("evidence_weight"), F.sum("groups").alias("groups"),
        F.expr("listagg(case when missing then factor_name end, ', ') within group (order by ord)").alias("missing_names"),
    )
    geo = F.when(F.col("lw") > 0, (F.col("lw") * F.exp(F.col("l") / F.col("lw")) + F.col("a")) / (F.col("lw") + F.col("aw"))).otherwise(F.col("a") / F.col("aw"))
    add = F.col("c") / F.col("w")
    score = {"additive": add, "geometric": geo}.get(model, 0.35 * add + 0.65 * geo)
    open_ = lambda x: F.when(F.col("blocked"), 0.0).otherwise(clamp(x))
    return agg.select(*by, open_(score).alias("score"), open_(add).alias("additive_score"), open_(geo).alias("geometric_score"), open_(F.col("r") / F.col("w")).alias("robust_score"), "evidence_count", "evidence_weight", "groups", "missing_names")


def ranked(scores: DataFrame) -> DataFrame:
    """Regret, relative return, status, rank and recommendation within each scope."""
    scope = Window.partitionBy("scope")
    best = F.max(F.when(~F.col("blocked"), F.col("score"))).over(scope)
    x = scores.withColumn("best", F.coalesce(best, F.lit(0.0))).withColumn("regret", F.when(F.col("blocked"), 0.0).otherwise(F.greatest(F.lit(0.0), F.col("best") - F.col("score"))))
    status = (
        F.when(F.col("blocked"), "impermissible")
        .when(F.abs(F.col("score") - F.col("best")) < 1e-12, "recommended")
        .when(F.col("regret") < 0.04, "investigate_first")
        .when((F.col("robust_score") < 0.30) & (F.col("regret") < 0.12), "too_risky")
        .when(F.col("regret") > 0.20, "dominated")
        .otherwise("permissible")
    )
    x = x.withColumn("status", status).withColumn("relative_return", F.coalesce(F.try_divide("score", "best"), F.lit(0.0)))
    return x.withColumn("rank", F.row_number().over(scope.orderBy("blocked", F.col("score").desc(), F.col("robust_score").desc(), "dord")))


def leader_gap(ranks: DataFrame) -> DataFrame:
    """Of each scope, the rounded gap between the first two that have evidence, and whether it is clear."""
    shown = ranks.where(F.col("evidence_count") > 0)
    order = Window.partitionBy("scope").orderBy("rank")
    x = shown.withColumn("place", F.row_number().over(order)).withColumn("gap", F.bround(F.col("score") - F.lead("score").over(order), 3)).where(F.col("place") == 1)
    return x.select("scope", "direction_id", "gap", (F.col("gap") >= 0.02).alias("clear"))


def cruxes(scores: DataFrame, ranks: DataFrame, most: int = 10) -> DataFrame:
    """Factors on which the first two directions of a scope differ, or whose uncertainty could change their order."""
    order = Window.partitionBy("scope").orderBy("rank")
    two = ranks.where(~F.col("blocked")).withColumn("place", F.row_number().over(order)).where(F.col("place") <= 2).select("scope", "direction_id", "place", "score")
    x = scores.join(F.broadcast(two), ["scope", "direction_id"])
    pick = lambda c, p: F.max(F.when(F.col("place") == p, c))
    c, e = F.col("contribution"), F.col("estimate.high") - F.col("estimate.low")
    f = x.groupBy("scope", "ord", "factor_id", "factor_name", "fw").agg(
        pick(c, 1).alias("ca"), pick(c, 2).alias("cb"), F.max(e).alias("width"), F.abs(pick(F.col("ew"), 1) - pick(F.col("ew"), 2)).alias("far"), F.greatest(F.lit(0.0), pick(F.col("score"), 1) - pick(F.col("score"), 2)).alias("gap")
    )
    share = F.col("fw") / F.sum("fw").over(Window.partitionBy("scope"))
    f = f.withColumn("share", share).withColumn("delta", (F.col("ca") - F.col("cb")) / F.sum("fw").over(Window.partitionBy("scope")))
    f = f.withColumn("voi", F.col("share") * F.col("width") * (0.7 + F.least(F.lit(1.0), F.col("far") / 10.0)))
    kept = f.where((F.abs("delta") >= F.greatest(F.lit(0.01), F.col("gap") * 0.20)) | (F.col("voi") >= 0.04))
    kept = kept.withColumn("flip", F.least(F.lit(1.0), F.col("gap") / F.greatest(F.lit(1e-9), F.col("share"))))
    place = F.row_number().over(Window.partitionBy("scope").orderBy(F.col("voi").desc(), "ord"))
    return kept.withColumn("place", place).where(F.col("place") <= most).select("scope", "factor_id", "factor_name", "delta", "gap", "flip", "voi", "place")


def evaluated(signals: DataFrame, directions: DataFrame, factors: DataFrame, scopes: tuple[str, ...] = SCOPES, attitude: str = "neutral", model: str = "hybrid") -> tuple[DataFrame, DataFrame]:
    """(scores by factor, ranked directions) of all scopes in one plan."""
    spark = signals.sparkSession
    known = signals.join(F.broadcast(directions.select("direction_id")), "direction_id", "left_semi").join(F.broadcast(factors.select("factor_id")), "factor_id", "left_semi")
    evidence = stage_two(stage_one(known))
    table = spark.createDataFrame([(s,) for s in scopes], "scope string")
    scores = factor_scores(evidence, directions, factors, table, attitude)
    return scores, ranked(direction_scores(scores, model))


def backing(signals: DataFrame) -> DataFrame:
    """direction_id, claim_id, best: the claims behind each direction, configured or not, with their best strength times
    relevance."""
    named = signals.where(F.coalesce("proposition_id", F.lit("")) != "")
    return named.groupBy("direction_id", F.col("proposition_id").alias("claim_id")).agg(F.greatest(F.lit(0.0), F.max(F.col("strength") * F.col("relevance"))).alias("best"))


def samples(backed: DataFrame, claims: DataFrame, most: int = 4, chars: int = 200) -> DataFrame:
    """direction_id, place, id, text: each direction's strongest claims; a claim that is not stored has an empty text."""
    order = Window.partitionBy("direction_id").orderBy(F.col("best").desc(), "claim_id")
    top = backed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    text = F.substring(F.coalesce("text", F.lit("")), 1, chars).alias("text")
    return top.join(claims.select(F.col("id").alias("claim_id"), "text"), "claim_id", "left").select("direction_id", "place", F.col("claim_id").alias("id"), text)


def option_scores(estimates: DataFrame, criteria: DataFrame, options: DataFrame, attitude: str = "neutral", default: tuple[float, float, float, float] = MISSING_PRIOR, mix: float = 0.5) -> DataFrame:
    """Options judged on criteria: estimates (option_id, criterion_id, est), criteria (criterion_id, weight, cost), options
    (option_id, ord, constraints array<struct<hard,satisfied,penalty>>, outcomes array<struct<p,value>>)."""
    cells = options.select("option_id", "ord").crossJoin(criteria.where(F.col("weight") > 0)).join(estimates, ["option_id", "criterion_id"], "left")
    none = estimate(*map(F.lit, default))
    e = ordered(F.coalesce(F.col("est"), none))
    cells = cells.withColumn("e", F.when(F.col("cost"), ordered(inverted(e))).otherwise(e))
    sums = cells.groupBy("option_id").agg((F.sum(F.col("weight") * risk_adjusted(F.col("e"), attitude)) / F.sum("weight")).alias("criteria_score"), (F.sum(F.col("weight") * F.col("e.low")) / F.sum("weight")).alias("robust"), F.max(F.col("e.high") - F.col("e.low")).alias("width"))
    broken = F.filter("constraints", lambda c: ~c["satisfied"])
    soft = F.least(F.lit(1.0), F.aggregate(F.filter(broken, lambda c: ~c["hard"]), F.lit(0.0), lambda s, c: s + c["penalty"]))
    mass = F.aggregate("outcomes", F.lit(0.0), lambda s, o: s + o["p"])
    ev = F.when(F.size("outcomes") > 0, clamp(F.aggregate("outcomes", F.lit(0.0), lambda s, o: s + o["p"] * o["value"]) / F.greatest(F.lit(1.0), mass)))
    x = options.join(sums, "option_id", "left").withColumn("blocked", F.exists(broken, lambda c: c["hard"])).withColumn("soft_penalty", soft).withColumn("outcome_value", ev)
    base = F.when(F.col("criteria_score").isNull(), F.coalesce("outcome_value", F.lit(0.0))).when(F.size("outcomes") > 0, (1 - mix) * F.col("criteria_score") + mix * F.col("outcome_value")).otherwise(F.col("criteria_score"))
    zero = lambda c: F.when(F.col("blocked"), 0.0).otherwise(clamp(c - F.col("soft_penalty")))
    x = x.withColumn("total_score", zero(base)).withColumn("robust_score", zero(F.coalesce("robust", F.lit(0.0))))
    everything = Window.partitionBy()
    best = F.coalesce(F.max(F.when(~F.col("blocked"), F.col("total_score"))).over(everything), F.lit(0.0))
    best_robust = F.coalesce(F.max(F.when(~F.col("blocked"), F.col("robust_score"))).over(everything), F.lit(0.0))
    x = x.withColumn("best", best).withColumn("best_robust", best_robust).withColumn("regret", F.when(F.col("blocked"), 0.0).otherwise(F.greatest(F.lit(0.0), F.col("best") - F.col("total_score"))))
    status = (
        F.when(F.col("blocked"), "impermissible")
        .when(F.abs(F.col("total_score") - F.col("best")) < 1e-12, "recommended")
        .when((F.col("robust_score") < 0.35) & (F.col("regret") < 0.08), "too_risky")
        .when((F.col("regret") < 0.05) & (F.col("width") > 0.25), "investigate_first")
        .when((F.col("regret") > 0.20) & (F.col("robust_score") <= F.col("best_robust") + 0.02), "dominated")
        .otherwise("permissible")
    )
    order = Window.orderBy("blocked", F.col("total_score").desc(), F.col("robust_score").desc(), "ord")
    return x.withColumn("status", status).withColumn("rank", F.row_number().over(order)).select("option_id", "total_score", "criteria_score", "robust_score", "outcome_value", "soft_penalty", "regret", "status", "rank")


def build_signals(judgments: DataFrame, claims: DataFrame, directions: DataFrame, factors: DataFrame) -> DataFrame:
    """Signals of judgments (line, raw JSON): known claims, directions and factors only; the first line of a key stays.
    A missing number takes its default, a null or unreadable one 0.5."""
    v = F.try_parse_json("raw")
    parsed = judgments.select("line", v.alias("v")).where(F.col("v").isNotNull())
    text = lambda k: F.try_variant_get("v", f"$.{k}", "string")

    def number(key: str, default: float) -> Column:
        there = F.array_contains(F.json_object_keys(F.to_json(F.col("v"))), key)
        x = F.expr(f"try_cast(try_variant_get(v, '$.{key}', 'string') as double)")
        return clamp(F.when(~there, default).otherwise(F.coalesce(F.when(~F.isnan(x), x), F.lit(0.5))))

    rows = parsed.select("line", text("claim_id").alias("claim_id"), text("direction_id").alias("direction_id"), text("factor_id").alias("factor_id"), F.lower(text("polarity")).alias("pol"), number("strength", 0.6).alias("strength"), number("relevance", 0.5).alias("relevance"), number("credence", 0.8).alias("credence"))
    known = rows.join(claims.select(F.col("id").alias("claim_id"), "source_id", "support_in_text"), "claim_id").join(F.broadcast(directions.select("direction_id")), "direction_id", "left_semi").join(F.broadcast(factors.select("factor_id")), "factor_id", "left_semi")
    first = F.row_number().over(Window.partitionBy("claim_id", "direction_id", "factor_id").orderBy("line"))
    s = clamp(F.coalesce("support_in_text", F.lit(0.5)))
    return known.withColumn("k", first).where(F.col("k") == 1).select(
        F.concat_ws("_", F.lit("sig"), "claim_id", "direction_id", "factor_id").alias("id"), "direction_id", "factor_id", F.when(F.col("pol").startswith("weak"), "weakens").otherwise("supports").alias("polarity"),
        "credence", "strength", "relevance", clamp(0.35 + 0.5 * s).alias("extraction_confidence"), clamp(0.3 + 0.5 * s).alias("evidence_quality"), F.lit(1.0).alias("source_weight"),
        F.coalesce(F.nullif(F.col("source_id"), F.lit("")), F.col("claim_id")).alias("dependency_key"), F.col("claim_id").alias("proposition_id"), "source_id",
    )


def proposition_quality(score: Column, low: Column, high: Column) -> Column:
    """Evidence quality of a proposition by its support in the text and the width of its credence."""
    return clamp(0.35 + 0.35 * score + 0.30 * (1 - (high - low)))


def proposition_signals(propositions: DataFrame) -> DataFrame:
    """Signals of propositions (id, direction_id, factor_id, polarity, credence, low, high, support_in_text, relevance,
    strength, dependency_key, source_claim_id, source_id); a signal's group is its dependency, else its claim, else itself."""
    key = F.coalesce(F.nullif(F.col("dependency_key"), F.lit("")), F.nullif(F.col("source_claim_id"), F.lit("")), F.col("id"))
    return propositions.select(
        F.concat_ws("_", F.lit("sig"), "id", "direction_id", "factor_id").alias("id"), "direction_id", "factor_id", "polarity", "credence", "strength", "relevance",
        F.col("support_in_text").alias("extraction_confidence"), proposition_quality(F.col("support_in_text"), F.col("low"), F.col("high")).alias("evidence_quality"),
        F.lit(1.0).alias("source_weight"), key.alias("dependency_key"), F.col("id").alias("proposition_id"), "source_id",
    )
