import json
import math

import pytest
from pyspark.sql import functions as F

from skein.operators import atlas as A
from skein.operators import decision as D
from skein.operators import similarity as S
from skein.operators import tables as G
from skein.sources import feeds, jsonl
from skein.streaming.ingest import ingest_batch, ingest_stream

ITEMS = "feed string, item_key string, url string, title string, author string, published string, text string, content_sha256 string"


def items(spark, *keys):
    text = "Taxes rose sharply in the spring. Wages were cut across the country. it was hard for them all."
    return spark.createDataFrame([("f", k, "u", "t", "a", "2026-01-01", text, "h") for k in keys], ITEMS)


def test_ingest_twice(spark, tmp_path):
    root = f"file://{tmp_path}/graph"
    one = ingest_batch(spark, items(spark, "a", "b"), root, "r1")
    two = ingest_batch(spark, items(spark, "b", "c"), root, "r2")
    three = ingest_batch(spark, items(spark, "b", "c"), root, "r3")
    assert (one["items_new"], two["items_new"], three["items_new"], three["items_skipped"]) == (2, 1, 0, 2)
    claims = jsonl.read(spark, f"{root}/claims", "claims")
    assert sorted(r[0] for r in claims.select("id").collect()) == [f"clm_{k:06d}" for k in range(1, 7)]
    sources = jsonl.read(spark, f"{root}/sources", "sources")
    assert "text" not in sources.columns and sources.agg(F.sum("claim_count")).first()[0] == 6
    with pytest.raises(ValueError, match="text"):
        jsonl.append(items(spark, "z"), f"{root}/sources", "sources")
    assert jsonl.read(spark, f"{root}/none", "edges").count() == 0


def test_stream(spark, tmp_path):
    items(spark, "a", "b").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(ITEMS).parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second finds nothing new
        ingest_stream(spark, stream, f"file://{tmp_path}/g", f"{tmp_path}/check").awaitTermination()
    assert jsonl.read(spark, f"file://{tmp_path}/g/claims", "claims").count() == 4


def test_feeds(spark):
    posts = {"data": {"posts": {"results": [{"title": "New", "pageUrl": "u1", "postedAt": "2026-02-01T00:00:00Z", "user": {"displayName": "n"}, "htmlBody": "<p>a</p><p>b</p>"}, {"title": "Old", "pageUrl": "u2", "postedAt": "2020-01-01", "htmlBody": "x"}]}}}
    rss = '<rss xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><item><title>T</title><link>l</link><description>short</description><content:encoded>&lt;p&gt;long&lt;/p&gt;</content:encoded><pubDate>Tue, 03 Feb 2026 10:00:00 GMT</pubDate><dc:creator>Who</dc:creator></item></channel></rss>'
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>P</title><summary>Sum</summary><id>i1</id><published>2026-03-01T00:00:00Z</published><author><name>Au</name></author></entry></feed>'
    config = [{"key": "g", "kind": "graphql-forum", "url": "http://x", "limit": 5}, {"key": "r", "kind": "rss", "url": "http://x", "limit": 5}, {"key": "x", "kind": "arxiv", "query": "q"}, {"key": "bad", "kind": "rss", "url": "http://x"}, {"key": "odd", "kind": "other"}]
    found, warnings = feeds.read_feeds(spark, config, "2026-01-01", {"g": json.dumps(posts), "r": rss, "x": atom, "bad": "<no"})
    got = {r["feed"]: r for r in found.collect()}
    assert got["g"]["text"] == "a\n\nb" and got["g"]["published"] == "2026-02-01T00:00:00+00:00" and len(got) == 3
    assert (got["r"]["text"], got["r"]["author"]) == ("long", "Who")
    assert got["x"]["text"] == "P\n\nSum"
    assert sorted(r[0].split(":")[0] for r in warnings.collect()) == ["bad", "odd"]


def test_pairs(spark):
    rows = spark.createDataFrame([("a", "s", "green apples taste fine"), ("b", "t", "green apples taste good"), ("c", "t", "blue pears"), ("d", "s", "green apples taste fine")], "id string, source string, text string")
    assert [(r.a, r.b) for r in S.pairs(rows, rows).orderBy("a", "b").collect()] == [("a", "b"), ("b", "d")]
    vecs = spark.createDataFrame([("a", 1, [1.0, 0.0]), ("b", 1, [1.0, 0.1]), ("c", 2, [0.9, 0.1]), ("z", 2, [0.0, 0.0])], "id string, source int, vec array<double>")
    near = S.nearest(vecs, vecs, top=1).collect()
    assert {(r.id, r.other) for r in near} == {("c", "b"), ("b", "c")} or {(r.id, r.other) for r in near} == {("c", "b")}


def test_protocol(spark):
    cols = "a string, b string, relation string, confidence double, judge string"
    old = spark.createDataFrame([("b", "a", "same", 0.5, "m"), ("a", "c", "supports", 0.4, "m")], cols)
    new = spark.createDataFrame([("a", "b", "same", 0.9, "m"), ("c", "d", "unrelated", 0.9, "m"), ("d", "c", "contradicts", 0.8, "m")], cols)
    got = {(r.a, r.b, r.relation): r.confidence for r in G.upsert_edges(old, new).collect()}
    assert got == {("a", "b", "same"): 0.9, ("a", "c", "supports"): 0.4, ("c", "d", "contradicts"): 0.8}
    assert G.to_verify(new).count() == 2
    claims = spark.createDataFrame([("c1", "x", "extracted"), ("c2", "y", None)], "id string, text string, status string")
    more = spark.createDataFrame([("c3", "z", "c1")], "id string, text string, refines_claim string")
    after = G.refine(claims, more)
    assert sorted(r.id for r in G.active(after).collect()) == ["c2", "c3"]
    tasks = spark.createDataFrame([(f"task_{k:06d}", "edge", "pending") for k in range(60)], "id string, kind string, status string")
    assert G.take_batch(tasks, "edge").count() == 50
    assert G.finish_tasks(tasks, spark.createDataFrame([("task_000001", "done")], "id string, result string")).where("status = 'done'").count() == 1
    edges = spark.createDataFrame([("a", "b", "same", False, None), ("a", "c", "same", False, None)], "a string, b string, relation string, verified boolean, verifier string")
    out = G.apply_verification(edges, spark.createDataFrame([("a", "b", "same", "confirm", "v"), ("a", "c", "same", "remove", "v")], "a string, b string, relation string, verdict string, verifier string"))
    assert [(r.a, r.b, r.verified, r.verifier) for r in out.collect()] == [("a", "b", True, "v")]


def test_numbers_across_partitions(spark):
    got = G.numbered(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")), ["k"]).collect()
    assert all(r.n == r.k + 1 for r in got)


def test_map(spark):
    c, s = math.cos, math.sin
    vecs = [("clm_1", [1.0, 0.0, 0.0]), ("clm_2", [0.25, math.sqrt(1 - 0.0625), 0.0]), ("clm_3", [0.0, 0.0, 1.0]), ("clm_4", [1.0, 0.01, 0.0])]
    rows = spark.createDataFrame(vecs, "id string, vec array<double>")
    got = {r.id: r for r in A.assign(rows).collect()}
    assert (got["clm_1"].ax, got["clm_1"].ay) == (0, 0) and got["clm_4"].district == got["clm_1"].district
    assert math.hypot(got["clm_2"].ax, got["clm_2"].ay) == pytest.approx(170, abs=0.1)
    places = {(r.ax, r.ay) for r in got.values()}
    assert all(math.dist(p, q) >= 150 for p in places for q in places if p != q)
    more = A.assign(spark.createDataFrame([*vecs, ("clm_5", [0.0, 0.9, -0.4])], "id string, vec array<double>")).collect()
    assert all((r.ax, r.ay) == (got[r.id].ax, got[r.id].ay) for r in more if r.id in got)
    kept = [{"id": r.district, "centroid": list(r.centroid), "x": r.ax, "y": r.ay, "created_run": "r"} for r in (got["clm_1"], got["clm_2"], got["clm_3"])]
    again = {r.id: r.district for r in A.assign(rows, kept).collect()}
    assert again == {k: v.district for k, v in got.items()}


def test_signals(spark):
    line = lambda **k: json.dumps({"claim_id": "c1", "direction_id": "d1", "factor_id": "scale"} | k)
    judged = spark.createDataFrame([(1, line(strength=None, credence="0.9")), (2, line(strength=1)), (3, line(factor_id="leverage", strength="x", polarity="Weakly")), (4, line(claim_id="no"))], "line int, raw string")
    claims = spark.createDataFrame([("c1", "s1", 0.4)], "id string, source_id string, support_in_text double")
    got = {r.factor_id: r for r in D.build_signals(judged, claims, spark.createDataFrame([("d1",)], "direction_id string"), D.factor_table(spark)).collect()}
    assert set(got) == {"scale", "leverage"}
    assert (got["scale"].strength, got["scale"].relevance, got["scale"].credence) == (0.5, 0.5, 0.9)
    assert (got["leverage"].strength, got["leverage"].polarity, got["leverage"].credence) == (0.5, "weakens", 0.8)
    assert got["scale"].extraction_confidence == pytest.approx(0.55)


def test_cap_and_block(spark):
    base = {"direction_id": "d1", "factor_id": "scale", "polarity": "supports", "credence": 1.0, "strength": 1.0, "relevance": 1.0, "extraction_confidence": 1.0, "evidence_quality": 1.0, "source_weight": 1.0, "proposition_id": "", "source_id": "s"}
    flood = [base | {"dependency_key": "one"} for _ in range(50)] + [base | {"dependency_key": "", "source_id": "", "credence": 0.0}, base | {"direction_id": "gone", "dependency_key": "k"}]
    signals = spark.createDataFrame([tuple(r.values()) for r in flood], ", ".join(f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in flood[0].items()))
    two = {r.direction_id: r for r in D.stage_two(D.stage_one(signals)).collect()}
    assert two["d1"].ew == pytest.approx(4.0) and two["d1"].groups == 2 and two["d1"].evidence_count == 51
    names = spark.createDataFrame([("d1", "One", 1, False), ("d2", "Two", 2, True)], "direction_id string, direction_name string, dord int, blocked boolean")
    scores, ranks = D.evaluated(signals, names, D.factor_table(spark))
    got = {(r.scope, r.direction_id): r for r in ranks.collect()}
    assert got["self", "d2"].status == "impermissible" and got["self", "d2"].score == 0 and got["self", "d1"].rank == 1
    assert {(r.kind, r.id) for r in D.unknown_ids(signals, names, D.factor_table(spark)).collect()} == {("direction", "gone")}


def test_options(spark):
    est = "struct<low:double,expected:double,high:double,confidence:double>"
    estimates = spark.createDataFrame([("a", "k", (0.6, 0.8, 0.9, 0.9)), ("b", "k", (0.1, 0.2, 0.3, 0.9)), ("c", "k", (0.9, 0.9, 0.9, 1.0))], f"option_id string, criterion_id string, est {est}")
    criteria = spark.createDataFrame([("k", 1.0, False), ("m", 1.0, True), ("z", 0.0, False)], "criterion_id string, weight double, cost boolean")
    options = spark.createDataFrame([("a", 1, [], [(0.7, 0.5), (0.7, 1.0)]), ("b", 2, [(False, False, 0.1)], []), ("c", 3, [(True, False, 0.0)], [])], "option_id string, ord int, constraints array<struct<hard:boolean,satisfied:boolean,penalty:double>>, outcomes array<struct<p:double,value:double>>")
    got = {r.option_id: r for r in D.option_scores(estimates, criteria, options).collect()}
    assert got["a"].criteria_score == pytest.approx((0.8 + 0.5) / 2) and got["a"].outcome_value == pytest.approx(0.75)
    assert got["a"].total_score == pytest.approx(0.7) and got["a"].status == "recommended"
    assert got["b"].total_score == pytest.approx(0.35 - 0.1) and got["c"].status == "impermissible" and got["c"].rank == 3


def test_proposition_signals(spark):
    cols = "id string, direction_id string, factor_id string, polarity string, credence double, low double, high double, support_in_text double, relevance double, strength double, dependency_key string, source_claim_id string, source_id string"
    rows = [("p1", "d", "f", "supports", 0.7, 0.5, 0.9, 0.4, 1.0, 0.5, "", "c9", "s"), ("p2", "d", "f", "weakens", 0.7, 0.7, 0.7, 1.0, 1.0, 0.5, "k", "c9", "s")]
    got = {r.proposition_id: r for r in D.proposition_signals(spark.createDataFrame(rows, cols)).collect()}
    assert got["p1"].evidence_quality == pytest.approx(0.35 + 0.14 + 0.18) and got["p1"].dependency_key == "c9"
    assert got["p2"].evidence_quality == pytest.approx(1.0) and got["p2"].dependency_key == "k"


def test_numbers_of_many_rows(spark):
    """Ranges are drawn from a sample here; ids must have no gap and no double."""
    rows = spark.range(3_000_000, numPartitions=16).select(F.xxhash64("id").alias("k"), F.lit("x" * 20).alias("more"))
    got = G.numbered(rows, ["k"]).agg(F.countDistinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(got) == (3_000_000, 1, 3_000_000)


def test_pair_tasks_and_replay(spark, tmp_path):
    root = f"file://{tmp_path}/p"
    text = "The new law reduced carbon emissions by 40 percent in 2020 across Europe."
    cols = "feed string, item_key string, url string, title string, author string, published string, text string, content_sha256 string"
    rows = [("f", k, "u", "t", "", "2026-01-01", text, "s") for k in ("a", "b")]
    first = ingest_batch(spark, spark.createDataFrame(rows[:1], cols), root, "r1")
    assert first["tasks_enqueued"]["identity_edge"] == 0
    for _ in range(2):  # the second try of a run replaces the first
        two = ingest_batch(spark, spark.createDataFrame(rows, cols), root, "r2", since="2025-01-01", warnings=("w",))
        assert (two["items_new"], two["items_skipped"], two["warnings"]) == (1, 1, ["w"])
    claims = jsonl.read(spark, f"{root}/claims", "claims")
    assert claims.count() == claims.select("id").distinct().count() == first["claims_extracted"] + two["claims_extracted"]
    pairs = jsonl.read(spark, f"{root}/tasks", "tasks").where("kind in ('identity', 'edge')").collect()
    assert pairs and all(t.payload.sim == 1.0 and t.kind == "identity" and t.payload.a < t.payload.b for t in pairs)
    assert json.loads("".join(r[0] for r in spark.read.text(f"{root}/runs/r2.json").collect()))["items_new"] == 1


def test_signal_files(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    spark.createDataFrame([('{"id": "s1", "direction_id": "d", "factor_id": "f", "strength": 0.25, "text": "x"}',), ("",)], "value string").write.text(path)
    got = jsonl.read_signals(spark, path)
    assert [(r.id, r.strength, r.relevance, r.polarity) for r in got.collect()] == [("s1", 0.25, 1.0, "supports")]
    jsonl.write_signals(got, path + "2")
    assert jsonl.read_signals(spark, path + "2").collect() == got.collect()
    for bad in ('{"id": "", "direction_id": "d", "factor_id": "f"}', '{"id": "x", "direction_id": "d", "factor_id": "f", "credence": 2}', "{no"):
        spark.createDataFrame([(bad,)], "value string").write.mode("overwrite").text(path + "3")
        with pytest.raises(Exception, match="invalid signal"):
            jsonl.read_signals(spark, path + "3").collect()


def test_token_pairs_by_blocks(spark, monkeypatch):
    """Pairs equal those of brute force whatever the blocks, and shared tokens are not joined row by row."""
    import random

    monkeypatch.setattr(S, "SETS_A_BLOCK", 20)
    draw = random.Random(5)
    words = [f"word{k}" for k in range(40)]
    rows = [(k, draw.choice("pqr"), " ".join(words[int(40 * draw.random() ** 2)] for _ in range(draw.choice((0, 1, 3, 9, 30))))) for k in range(200)]
    rows += [(200, None, rows[-1][2]), (201, "p", None), (202, "q", "nobody else says this"), (203, "p", rows[-1][2])]
    sets = {k: (s, set((t or "").split()) - {"this"}) for k, s, t in rows}
    want = {}
    for a, (s, x) in sets.items():
        for b, (r, y) in sets.items():
            if a < b and s != r and x and y and len(x & y) / len(x | y) >= 0.3:
                want[a, b] = round(len(x & y) / len(x | y), 4)
    df = spark.createDataFrame(rows, "id long, source string, text string")
    whole = S.token_pairs(df, df)
    assert {(r.a, r.b): r.sim for r in whole.collect()} == want and len(want) > 500
    assert "Join" not in whole._jdf.queryExecution().optimizedPlan().toString()
    some = {(r.a, r.b): r.sim for r in S.token_pairs(df.where("id < 50"), df).collect()}
    assert some == {k: v for k, v in want.items() if k[0] < 50}


def test_nearest_by_blocks(spark, monkeypatch):
    """Equal to brute force with ties, over blocks and tiles; rows without a vector are near to none."""
    import numpy as np

    monkeypatch.setattr(S, "VECTORS_A_BLOCK", 25)
    monkeypatch.setattr(S, "TILE", 8)
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(size=(240, 3)), 1)
    v[100:140] = v[:40]  # ties
    v[7] = 0
    src = rng.integers(0, 4, len(v))
    unit = v / np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-300)
    sims = np.round(unit @ unit.T, 12)
    want = set()
    for i in range(len(v)):
        best = sorted(((sims[i, j], j) for j in range(len(v)) if j != i), reverse=True)[: S.TOP]
        want |= {(i, j, k + 1) for k, (c, j) in enumerate(best) if c >= S.LEAST_COSINE and src[i] != src[j]}
    rows = [(i, int(src[i]), v[i].tolist()) for i in range(len(v))] + [(900, 1, None)]
    df = spark.createDataFrame(rows, "id long, source int, vec array<float>")
    exact = spark.createDataFrame(rows, "id long, source int, vec array<double>")
    assert {(r.id, r.other, r["rank"]) for r in S.nearest(exact, exact).collect()} == want and len(want) > 100
    assert S.nearest(df.where("id < 30"), df).where("id >= 30").count() == 0
    assert S.nearest(df.limit(0), df).count() == 0
