"""Options judged on criteria and outcomes within scopes, with what is missing and what could change the order.

Questions, criteria, options and scopes are small configured tables; estimates are joined to their cells. All scopes are
one plan: a scope is a column of every row, not a run of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .decision import MISSING_PRIOR, clamp, estimate, inverted, ordered, risk_adjusted

#: The weight of an outcome of another scope, of exploration, and how many cruxes are shown.
OTHER_SCOPE, EXPLORATION, CRUXES = 0.5, 0.05, 8


def cells(options: DataFrame, criteria: DataFrame, estimates: DataFrame, scopes: DataFrame, attitude: str = "neutral", default: tuple[float, float, float, float] = MISSING_PRIOR) -> DataFrame:
    """A row a scope, option and criterion of some weight: options (option_id, ord), criteria (criterion_id, criterion_name,
    cord, weight, scope_weights, cost), estimates (option_id, criterion_id, est), scopes (scope, beneficiaries
    map<string,double>). A criterion that an option has no estimate for takes the default and is marked."""
    own = F.coalesce(F.try_element_at("scope_weights", F.col("scope")), F.lit(1.0))
    shared = F.coalesce(F.try_element_at("beneficiaries", F.col("scope")), F.lit(1.0))
    x = scopes.crossJoin(options.select("option_id", "ord")).crossJoin(criteria)  # configured tables
    x = x.withColumn("w", F.col("weight") * own * shared).where(F.col("w") > 0).join(estimates, ["option_id", "criterion_id"], "left")
    x = x.withColumn("e", ordered(F.coalesce(F.col("est"), estimate(*map(F.lit, default)))))
    x = x.withColumn("e", F.when(F.col("cost"), ordered(inverted(F.col("e")))).otherwise(F.col("e")))
    x = x.withColumn("score", risk_adjusted(F.col("e"), attitude))
    return x.select("scope", "option_id", "ord", "criterion_id", "criterion_name", "cord", "w", "e", "score", (F.col("w") * F.col("score")).alias("contribution"), F.col("est").isNull().alias("missing"))


def outcome_value(attitude: str) -> Column:
    """Of outcomes (p, value as an estimate, scope), the expected value in a scope; branches of other scopes count by that
    scope's beneficiary weight. Masses above 1 are brought to 1. Null without outcomes."""
    p = lambda o: o["p"] * F.when(o["scope"].isNull() | (o["scope"] == F.col("scope")), 1.0).otherwise(F.coalesce(F.try_element_at("beneficiaries", o["scope"]), F.lit(OTHER_SCOPE)))
    mass = F.aggregate("outcomes", F.lit(0.0), lambda s, o: s + p(o))
    total = F.aggregate("outcomes", F.lit(0.0), lambda s, o: s + p(o) * risk_adjusted(ordered(o["value"]), attitude))
    return F.when(F.size("outcomes") > 0, clamp(total / F.greatest(F.lit(1.0), mass)))


def ranked(options: DataFrame, judged: DataFrame, scopes: DataFrame, attitude: str = "neutral", mix: float = 0.5) -> DataFrame:
    """A row a scope and option: options (option_id, option_name, ord, constraints array<struct<hard,satisfied,penalty>>,
    outcomes array<struct<p,value,scope>>, exploration estimate or null), judged as from `cells`."""
    sums = judged.groupBy("scope", "option_id").agg(
        (F.sum("contribution") / F.sum("w")).alias("criteria"), (F.sum(F.col("w") * F.col("e.low")) / F.sum("w")).alias("low"),
        F.max(F.col("e.high") - F.col("e.low")).alias("width"), F.expr("listagg(case when missing then criterion_name end, ', ') within group (order by cord)").alias("missing_names"),
    )
    broken = F.filter("constraints", lambda c: ~c["satisfied"])
    soft = F.least(F.lit(1.0), F.aggregate(F.filter(broken, lambda c: ~c["hard"]), F.lit(0.0), lambda s, c: s + c["penalty"]))
    x = scopes.crossJoin(options).join(sums, ["scope", "option_id"], "left")
    x = x.withColumn("blocked", F.coalesce(F.exists(broken, lambda c: c["hard"]), F.lit(False))).withColumn("soft_penalty", F.coalesce(soft, F.lit(0.0))).withColumn("outcome_value", outcome_value(attitude))
    score = F.coalesce("criteria", F.lit(0.0))
    base = F.when(F.col("outcome_value").isNull(), score).when(F.col("criteria").isNull(), F.col("outcome_value")).otherwise((1 - mix) * score + mix * F.col("outcome_value"))
    bonus = F.coalesce(EXPLORATION * risk_adjusted(ordered(F.col("exploration")), attitude), F.lit(0.0)) if "exploration" in options.columns else F.lit(0.0)
    open_ = lambda c: F.when(F.col("blocked"), 0.0).otherwise(clamp(c - F.col("soft_penalty")))
    x = x.withColumn("bonus", bonus).withColumn("total_score", open_(base + F.col("bonus"))).withColumn("robust_score", open_(F.coalesce("low", F.lit(0.0)))).withColumn("criteria_score", score)
    scope = Window.partitionBy("scope")
    best = lambda c: F.coalesce(F.max(F.when(~F.col("blocked"), F.col(c))).over(scope), F.lit(0.0))
    x = x.withColumns({"best": best("total_score"), "best_robust": best("robust_score")})
    x = x.withColumn("regret", F.when(F.col("blocked"), 0.0).otherwise(F.greatest(F.lit(0.0), F.col("best") - F.col("total_score"))))
    status = (
        F.when(F.col("blocked"), "impermissible")
        .when(F.abs(F.col("total_score") - F.col("best")) < 1e-12, "recommended")
        .when((F.col("robust_score") < 0.35) & (F.col("regret") < 0.08), "too_risky")
        .when((F.col("regret") < 0.05) & (F.coalesce("width", F.lit(0.0)) > 0.25), "investigate_first")
        .when((F.col("regret") > 0.20) & (F.col("robust_score") <= F.col("best_robust") + 0.02), "dominated")
        .otherwise("permissible")
    )
    place = F.row_number().over(scope.orderBy("blocked", F.col("total_score").desc(), F.col("robust_score").desc(), "ord"))
    return x.withColumn("status", status).withColumn("rank", place).select("scope", "option_id", "option_name", "total_score", "criteria_score", "robust_score", "outcome_value", "bonus", "soft_penalty", "regret", "status", "rank", "blocked", "missing_names")


def cruxes(judged: DataFrame, ranks: DataFrame, most: int = CRUXES) -> DataFrame:
    """Criteria on which the first two permissible options of a scope differ, or whose uncertainty could change their order.
    A scope with fewer than two such options has none."""
    order = Window.partitionBy("scope").orderBy("rank")
    two = ranks.where(~F.col("blocked")).withColumn("seat", F.row_number().over(order)).where(F.col("seat") <= 2).select("scope", "option_id", "seat", "total_score")
    pick = lambda c, k: F.max(F.when(F.col("seat") == k, c))
    both = judged.join(two, ["scope", "option_id"]).groupBy("scope", "criterion_id", "criterion_name", "cord", "w").agg(
        pick(F.col("contribution"), 1).alias("first"), pick(F.col("contribution"), 2).alias("second"), F.max(F.col("e.high") - F.col("e.low")).alias("width"),
        F.min("e.confidence").alias("sure"), F.greatest(F.lit(0.0), pick(F.col("total_score"), 1) - pick(F.col("total_score"), 2)).alias("gap"),
    )
    share = F.col("w") / F.sum("w").over(Window.partitionBy("scope"))
    x = both.where(F.col("second").isNotNull()).withColumn("share", share)
    x = x.withColumn("delta", (F.col("first") - F.col("second")) * F.col("share") / F.col("w")).withColumn("voi", F.col("share") * F.col("width") * (1.5 - F.col("sure")))
    x = x.where((F.abs("delta") >= F.greatest(F.lit(0.015), F.col("gap") * 0.25)) | (F.col("voi") >= 0.05)).withColumn("flip", F.least(F.lit(1.0), F.col("gap") / F.col("share")))
    place = F.row_number().over(Window.partitionBy("scope").orderBy(F.col("voi").desc(), "cord"))
    return x.withColumn("place", place).where(F.col("place") <= most).select("scope", "criterion_id", "criterion_name", "delta", "gap", "flip", "voi", "place")


def evaluated(options: DataFrame, criteria: DataFrame, estimates: DataFrame, scopes: DataFrame, attitude: str = "neutral", mix: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(cells, ranked options) of all scopes."""
    judged = cells(options, criteria, estimates, scopes, attitude)
    return judged, ranked(options, judged, scopes, attitude, mix)
