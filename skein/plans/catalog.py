"""Queries over the driver's tables and their DuckDB text.

The tables hold no claims, edges or signals, so the shapes of the claim graph are projected from them: documents are
items and claims, embeddings are claim vectors (their label is the source), events are signals, orders are tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..functions.html import html_text
from ..operators import atlas as A
from ..operators import claims as C
from ..operators import decision as D
from ..operators import options as O
from ..operators import similarity as S
from ..operators import tables as G
from ..operators.durable import kept

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Text ---------------------------------------------------------------------------------------------------------------

def _word(alternation: str) -> str:
    """A word test for an engine without Unicode boundaries; the text is lower-case and has a space at either end."""
    return "[^\\p{L}\\p{N}_](?:" + alternation.replace("'", "''") + ")[^\\p{L}\\p{N}_]"


_ABBR = "|".join(a.replace(".", "\\.") for a in sorted(L.ABBREVIATIONS, key=len, reverse=True))
_CITE = "\\[[0-9]+(?:\\s*,\\s*[0-9]+)*\\]"
_HIDE = f"'(^|[^\\p{{L}}\\p{{N}}_.])({_ABBR}|[0-9]{{1,2}}|[A-Z])\\.((?:{_CITE})?\\s)', '\\1\\2\u0002\\3', 'g'"
_SENTENCES = f"""
clean as (select *, trim(regexp_replace(regexp_replace(regexp_replace(text, '[\\t\\x0b\\x0c]', ' ', 'g'), ' *\\n *', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10)) as body from documents),
blocks as (select *, unnest(regexp_split_to_array(body, '\\n\\s*\\n')) as block from clean),
hidden as (select *, regexp_replace(regexp_replace(block, {_HIDE}), {_HIDE}) as h from blocks),
cut as (select *, regexp_replace(h, '([.!?])({_CITE})?\\s+(["''“‘(]*[A-Z0-9])', '\\1\\2\u0001\\3', 'g') as m from hidden),
sentences as (select * from (select *, trim(replace(unnest(string_split(m, '\u0001')), '\u0002', '.'), ' ' || chr(10)) as sentence from cut) where sentence <> '')
"""


def _is(alternation: str) -> str:
    return f"regexp_matches(s, '{_word(alternation)}')"


_NUM = "regexp_matches(u, '[0-9]') or " + "regexp_matches(u, '" + _word(L.NUMBER_WORDS) + "')"
_QUANT = "regexp_matches(u, '[0-9]') or " + "regexp_matches(u, '" + _word(L.QUANTITY_WORDS) + "')"
_TYPES_SQL = f"""
with {_SENTENCES},
x as (select *, ' ' || lower(sentence) || ' ' as s, ' ' || regexp_replace(lower(sentence), '{_CITE}', ' ', 'g') || ' ' as u from sentences),
typed as (select lang, case
  when {_is(L.NORMATIVE)} then 'normative' when {_is(L.DEFINITIONAL)} then 'definitional' when {_is(L.CAUSAL)} then 'causal'
  when {_is(L.PREDICTIVE)} then 'predictive' when {_QUANT} then 'statistical'
  when {_is(L.HIGH_STAKES)} then case when regexp_matches(s, '{L.MEDICAL}') then 'medical' when regexp_matches(s, '{L.FINANCIAL}') then 'financial' else 'legal' end
  when {_is(L.HISTORICAL)} then 'historical'
  when {_is(L.CLAIM_VERBS)} then case when {_is(L.WORLDLY)} then 'empirical' else 'descriptive' end else 'other' end as type,
  greatest(0, least(1, 0.25 + case when {_is(L.SOURCE)} then 0.25 else 0 end + case when regexp_matches(s, '{_CITE}|https?://|www\\.') then 0.3 else 0 end
    + case when {_NUM} then 0.1 else 0 end + case when {_is(L.HEDGE)} then 0.07 else 0 end - case when {_is(L.ABSOLUTE)} and not {_is(L.SOURCE)} then 0.12 else 0 end)) as score
  from x where {_is(L.CLAIM_VERBS)} or {_is(L.CAUSAL)} or {_is(L.ABSOLUTE)} or {_is(L.NORMATIVE)} or {_is(L.DEFINITIONAL)} or {_NUM})
select lang, type, count(*) as claims, round(avg(score), 4) as support from typed group by all
"""


@query(_TYPES_SQL)
def q_claims_by_type(spark, sf):
    """Sentences that signal a claim, by language and type, with their mean support."""
    s = F.col("sentence")
    rows = C.sentence_rows(read(spark, sf, "documents"), keep=("doc_id", "lang"), headings=True).where(C.signals_claim(s))
    return rows.select("lang", C.claim_type(s).alias("type"), C.support(s, s).alias("score")).groupBy("lang", "type").agg(F.count("*").alias("claims"), F.round(F.avg("score"), 4).alias("support"))


@query(f"with {_SENTENCES} select doc_id, count(*) as sentences, sum(length(sentence))::bigint as chars from sentences group by doc_id")
def q_sentences(spark, sf):
    rows = C.sentence_rows(read(spark, sf, "documents"), headings=True)
    return rows.groupBy("doc_id").agg(F.count("*").alias("sentences"), F.sum(F.length("sentence")).alias("chars"))


@query()
def q_claims(spark, sf):
    """All claims of all documents with genre-dependent flags."""
    return C.claim_rows(read(spark, sf, "documents"), internal=True)


@query("""select conv_id, turn, case when length(text) >= 300 then left(text, 300) when coalesce(before, '') = '' then text
  when length(before) <= 300 - length(text) - 1 then before || ' ' || text
  when length(text) > 297 then text
  when k = '' then text else '…' || k || ' ' || text end as quote from (
  select *, ltrim(case when substr(tail, 1, 1) in (' ', chr(10)) or substr(before, length(before) - (299 - length(text)) + 1, 1) in (' ', chr(10)) then tail
    when position(' ' in tail) > 0 then substr(tail, position(' ' in tail)) else '' end, ' ' || chr(10)) as k from (
  select *, right(before, greatest(0, 298 - length(text))) as tail from (
  select conv_id, turn, text, lag(text) over (partition by conv_id order by turn) as before from conversations)))""")
def q_prev_context(spark, sf):
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    return read(spark, sf, "conversations").withColumn("before", before).select("conv_id", "turn", C.quote(F.col("before"), F.col("text")).alias("quote"))


@query(f"""with {_SENTENCES} select doc_id, count(*) as fragments from sentences where regexp_matches(sentence, '^\\p{{Ll}}')
  or len(list_filter(regexp_split_to_array(sentence, '\\s+'), lambda w: w <> '')) < 5
  or regexp_replace(lower(regexp_extract(sentence, '^\\S+')), '[,.;:]+$', '') in {L.DANGLING_HEADS} group by doc_id""")
def q_needs_refine(spark, sf):
    return C.sentence_rows(read(spark, sf, "documents"), headings=True).where(T.needs_refining(F.col("sentence"))).groupBy("doc_id").agg(F.count("*").alias("fragments"))


_TOKENS = f"list_filter(regexp_extract_all(lower(text), '[a-z0-9'']+'), lambda t: length(t) > 2 and t not in {L.STOP_WORDS})"


@query(f"select source, token, count(*) as n from (select source, unnest({_TOKENS}) as token from documents) group by all")
def q_token_tf(spark, sf):
    return read(spark, sf, "documents").select("source", F.explode(T.tokens(F.col("text"))).alias("token")).groupBy("source", "token").agg(F.count("*").alias("n"))


@query(f"""with own as (select source, token, count(*) as n from (select source, unnest({_TOKENS}) as token from documents) group by all),
 every as (select token, sum(n) as g from own group by token), scored as (select source, token, n * ln(1 + (select sum(g) from every) / g) as score from own join every using (token)),
 top as (select *, row_number() over (partition by source order by score desc, token) as place from scored)
 select source, string_agg(token, ' · ' order by place) as label from top where place <= 3 group by source""")
def q_label_top3(spark, sf):
    return A.labels(read(spark, sf, "documents"), "source")


@query(f"""with t as (select doc_id, source, list_distinct({_TOKENS}) as k from documents), e as (select doc_id, source, len(k) as n, unnest(k) as token from t),
 p as (select a.doc_id as x, b.doc_id as y, a.n as nx, b.n as ny, count(*) as shared from e a join e b on a.token = b.token and a.doc_id < b.doc_id and a.source <> b.source group by all)
 select x as a, y as b, round_even(shared / (nx + ny - shared), 4) as sim from p where shared / (nx + ny - shared) >= 0.3""")
def q_jaccard_pairs(spark, sf):
    docs = read(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source", "text")
    return S.token_pairs(docs, docs)


_KNN = """with v as (select vec_id, embedding::double[] as e, label from embeddings), s as (select a.vec_id as id, b.vec_id as other, a.label = b.label as same, list_cosine_similarity(a.e, b.e) as c from v a join v b on a.vec_id <> b.vec_id),
 r as (select *, row_number() over (partition by id order by c desc, other desc) as rank from s)"""


@query(f"{_KNN} select id, other, round(c, 4) as sim, rank from r where rank <= 4 and c >= 0.40 and not same")
def q_knn_cross_source(spark, sf):
    rows = read(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("source"), F.col("embedding").alias("vec"))
    return S.nearest(rows, rows).select("id", "other", F.round("sim", 4).alias("sim"), F.col("rank").cast("long").alias("rank"))


def _edges(spark, sf) -> DataFrame:
    """Edges of nearest vectors: those of odd pairs contradict, the others support; similar ones are verified. They are kept,
    as queries read them more than once."""
    rows = read(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("source"), F.col("embedding").alias("vec"))
    p = kept(S.vector_pairs(rows, rows))
    return p.select("a", "b", F.when((F.col("a") + F.col("b")) % 2 == 1, "contradicts").otherwise("supports").alias("relation"), F.col("sim").alias("confidence"), F.lit("m-1").alias("judge"), (F.col("sim") >= 0.42).alias("verified"), F.concat_ws("-", "a", "b").alias("note"))


_EDGES = _KNN + """, edges as (select least(id, other) as a, greatest(id, other) as b, case when (id + other) % 2 = 1 then 'contradicts' else 'supports' end as relation, round_even(max(c), 4) as confidence,
  round_even(max(c), 4) >= 0.42 as verified, concat_ws('-', least(id, other), greatest(id, other)) as note from r where rank <= 4 and c >= 0.40 and not same group by all)"""
# group by all would part pairs by relation only, which both directions share
_EDGES = _EDGES.replace(" group by all)", " group by 1, 2, 3)").replace("concat_ws('-', least(id, other), greatest(id, other)) as note", "any_value(concat_ws('-', least(id, other), greatest(id, other))) as note")


@query(f"{_EDGES} select case when confidence >= 0.45 then 'identity' else 'edge' end as kind, count(*) as n from edges group by 1")
def q_identity_vs_edge(spark, sf):
    return _edges(spark, sf).groupBy(S.pair_kind(F.col("confidence"), 0.45).alias("kind")).agg(F.count("*").alias("n"))


@query(f"""{_EDGES}, lit as (select a as id from edges union select b from edges) select label as district, count(*) as claims, count(lit.id) as lit, count(*) - count(lit.id) as dim,
  round_even(least(40 + 14 * sqrt(count(*)), 170), 2) as r from embeddings left join lit on lit.id = vec_id group by label having count(*) >= 2""")
def q_lit_dim(spark, sf):
    return A.districts(read(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("district")), _edges(spark, sf))


@query(f"""{_EDGES} select d as district, count(*) as tensions from (select unnest(list_distinct([x.label, y.label])) as d from edges join embeddings x on x.vec_id = a join embeddings y on y.vec_id = b where relation = 'contradicts') group by d""")
def q_tensions(spark, sf):
    claims = read(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("district"))
    return A.district_tensions(A.tensions(_edges(spark, sf), claims), claims)


@query(f"{_EDGES} select a, b, confidence, note from edges where verified order by confidence desc, a desc, b desc limit 1")
def q_sharpest_fault(spark, sf):
    return A.sharpest_fault(_edges(spark, sf))


@query(f"{_EDGES} select relation, count(*) as n, round(sum(confidence), 2) as weight from (select a, b, relation, case when a % 2 = 0 then 1.0 else confidence end as confidence from edges) group by relation")
def q_edge_upsert(spark, sf):
    old = _edges(spark, sf).drop("verified")
    judged = old.where(F.col("a") % 2 == 0).withColumn("confidence", F.lit(1.0))
    return G.upsert_edges(old, judged).groupBy("relation").agg(F.count("*").alias("n"), F.round(F.sum("confidence"), 2).alias("weight"))


@query(f"{_EDGES} select a, b, relation, 'm-1' as edge_judge from edges where relation = 'contradicts'")
def q_verify_queue(spark, sf):
    return G.to_verify(_edges(spark, sf))


@query("""with p as (select vec_id, label, row_number() over (partition by label order by vec_id) as joined, sha256(vec_id::varchar) as h from embeddings),
 u as (select *, ('0x' || substr(h, 1, 16))::ubigint::double / 18446744073709551616.0 as t, ('0x' || substr(h, 17, 16))::ubigint::double / 18446744073709551616.0 as f from p)
 select vec_id, joined, round(sqrt(f) * greatest(least(40 + 14 * sqrt(joined), 170) - 6, 0) * cos(t * 2 * pi()), 2) as dx, round(sqrt(f) * greatest(least(40 + 14 * sqrt(joined), 170) - 6, 0) * sin(t * 2 * pi()), 2) as dy from u""")
def q_jitter(spark, sf):
    joined = F.row_number().over(Window.partitionBy("label").orderBy("vec_id"))
    rows = read(spark, sf, "embeddings").select("vec_id", joined.cast("long").alias("joined"))
    dx, dy = A.jitter(F.col("vec_id").cast("string"), F.col("joined"))
    return rows.select("vec_id", "joined", F.round(dx, 2).alias("dx"), F.round(dy, 2).alias("dy"))


@query("""with p as (select p_size * 10.0 as x, p_retailprice as y from part), d as (select s_suppkey * 1.0 as x, s_acctbal as y, 50.0 as r from supplier),
 e as (select x as x0, x as x1, y as y0, y as y1 from p union all select x - r, x + r, y - r, y + r from d), b as (select min(x0) as x0, max(x1) as x1, min(y0) as y0, max(y1) as y1 from e), m as (select *, greatest(x1 - x0, y1 - y0) * 0.05 as pad from b)
 select round(x0 - pad, 2)::double as min_x, round(x1 + pad, 2)::double as max_x, round(y0 - pad, 2)::double as min_y, round(y1 + pad, 2)::double as max_y from m""")
def q_bounds(spark, sf):
    points = read(spark, sf, "part").select((F.col("p_size") * 10.0).alias("x"), F.col("p_retailprice").alias("y"))
    return A.bounds(points, read(spark, sf, "supplier").select((F.col("s_suppkey") * 1.0).alias("x"), F.col("s_acctbal").alias("y"), F.lit(50.0).alias("r")))


@query("select doc_id, 'd_' || lpad((dense_rank() over (order by source))::varchar, 3, '0') as district from documents")
def q_feed_districts(spark, sf):
    return A.assign_by_feed(read(spark, sf, "documents").select("doc_id", F.col("source").alias("feed"))).select("doc_id", "district")


@query()
def q_anchor_assign(spark, sf):
    """Order-dependent clusters of all vectors."""
    claims = read(spark, sf, "embeddings").select(F.format_string("clm_%06d", "vec_id").alias("id"), F.col("embedding").alias("vec"))
    return A.assign(claims).select("id", "district", "ax", "ay")


@query()
def q_genre(spark, sf):
    return read(spark, sf, "documents").select("doc_id", T.genre(F.col("text")).alias("genre"))


# Tables -------------------------------------------------------------------------------------------------------------

@query("select source as feed, doc_id::varchar as item_key from documents where doc_id % 2 <> 0")
def q_seen_antijoin(spark, sf):
    items = read(spark, sf, "documents").select(F.col("source").alias("feed"), F.col("doc_id").cast("string").alias("item_key"))
    seen = G.seen_keys(items.where(F.col("item_key").cast("long") % 2 == 0).select("feed", F.concat_ws("_", F.lit("src"), "feed", "item_key").alias("id")))
    return G.unseen(items, seen)


@query("select doc_id, 'clm_' || lpad((row_number() over (order by source, doc_id) + 41)::varchar, 6, '0') as id from documents")
def q_assign_ids(spark, sf):
    old = spark.createDataFrame([("clm_000041",), ("clm_x",), ("clm_000007",)], "id string")
    return G.assign_ids(read(spark, sf, "documents").select("doc_id", "source"), old, "clm", ["source", "doc_id"]).select("doc_id", "id")


@query("select event_id, user_id, event_type from (select *, row_number() over (partition by user_id, event_type order by event_id) as k from events) where k = 1")
def q_dedupe_first(spark, sf):
    return G.keep_first(read(spark, sf, "events").select("event_id", "user_id", "event_type"), ["user_id", "event_type"], "event_id")


@query("select coalesce(o_orderpriority, 'unknown') as kind, count(*) as pending from orders where o_orderstatus = 'O' group by 1")
def q_pending_by_kind(spark, sf):
    status = F.when(F.col("o_orderstatus") == "O", "pending").otherwise("done")
    return G.pending_by_kind(read(spark, sf, "orders").select(F.col("o_orderpriority").alias("kind"), status.alias("status")))


@query("select o_orderstatus as status, count(*) as n from orders where o_orderstatus is distinct from 'F' group by 1")
def q_active_filter(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "retired").otherwise(F.col("o_orderstatus"))
    return G.active(read(spark, sf, "orders").select(status.alias("status"))).groupBy("status").agg(F.count("*").alias("n"))


@query("select coalesce(max(source), 'unknown') as run_id from documents")
def q_latest_run(spark, sf):
    return G.latest_run(read(spark, sf, "documents").select(F.col("source").alias("run_id")))


@query("select page_id, sha256(html) as sha from pages")
def q_page_hash(spark, sf):
    return read(spark, sf, "pages").select("page_id", F.sha2(F.col("html"), 256).alias("sha"))


@query()
def q_strip_html(spark, sf):
    return read(spark, sf, "pages").select("page_id", "url", html_text(F.col("html")).alias("text"))


# Rankings -----------------------------------------------------------------------------------------------------------

def _signals(spark, sf) -> DataFrame:
    """Events as signals: type is the direction, k modulo 8 the factor, the user the dependency group."""
    k = F.get_json_object("props", "$.k").cast("long") % 8
    names = F.array(*[F.lit(f[0]) for f in D.FACTORS])
    share = lambda a, n: (F.pmod(F.col("event_id") * a, F.lit(n)) / n).cast("double")
    return read(spark, sf, "events").select(
        F.col("event_id"), F.col("event_type").alias("direction_id"), F.get(names, k).alias("factor_id"), F.when(F.col("event_id") % 3 == 0, "weakens").otherwise("supports").alias("polarity"),
        share(7, 100).alias("credence"), share(11, 97).alias("strength"), share(13, 89).alias("relevance"), F.lit(0.8).alias("extraction_confidence"), F.lit(0.7).alias("evidence_quality"), F.lit(1.0).alias("source_weight"),
        F.when(F.col("event_id") % 5 == 0, "").otherwise(F.col("user_id").cast("string")).alias("dependency_key"), F.lit("s").alias("source_id"), F.lit(None).cast("string").alias("proposition_id"),
    )


_SIGNALS = f"""with base as (select event_type as direction_id, {[f[0] for f in D.FACTORS]}[(json_extract_string(props, '$.k')::bigint % 8) + 1] as factor_id,
  case when event_id % 3 = 0 then -1.0 else 1.0 end::double as sign, ((event_id * 7) % 100)::double / 100 as credence, ((event_id * 11) % 97)::double / 97 as strength, ((event_id * 13) % 89)::double / 89 as relevance,
  case when event_id % 5 = 0 then 's' else user_id::varchar end as dep from events),
 rated as (select direction_id, factor_id, dep, 1.0::double * relevance * 0.8::double * 0.7::double * greatest(0.05::double, strength) as w, least(1::double, greatest(0::double, 0.5::double + sign * (credence - 0.5::double) * strength)) as v from base),
 one as (select direction_id, factor_id, dep, sum(w) as sw, sum(v * w) / sum(w) as mean, count(*) as n from rated where w >= 1e-9 group by all),
 two as (select direction_id, factor_id, sum(least(sw, 3.0::double)) as ew, sum(least(sw, 3.0::double) * mean) / sum(least(sw, 3.0::double)) as emean, greatest(0::double, sum(least(sw, 3.0::double) * mean * mean) / sum(least(sw, 3.0::double)) - (sum(least(sw, 3.0::double) * mean) / sum(least(sw, 3.0::double))) ** 2) as evar, count(*) as groups, sum(n)::bigint as evidence_count from one group by all)"""


@query(f"{_SIGNALS} select direction_id, factor_id, dep, round(sw, 6) as sw, round(mean, 6) as mean, n from one")
def q_signal_stage1(spark, sf):
    return D.stage_one(_signals(spark, sf)).select("direction_id", "factor_id", "dep", F.round("sw", 6).alias("sw"), F.round("mean", 6).alias("mean"), "n")


@query(f"{_SIGNALS} select direction_id, factor_id, round(ew, 6) as ew, round(emean, 6) as emean, round(evar, 6) as evar, groups, evidence_count from two")
def q_signal_capped(spark, sf):
    return D.stage_two(D.stage_one(_signals(spark, sf))).select("direction_id", "factor_id", *[F.round(c, 6).alias(c) for c in ("ew", "emean", "evar")], "groups", "evidence_count")


_FACTORS = "factors as (select * from (values " + ", ".join(f"({k}, '{f}', {w}::double, {cost}, {geo}, {s.get('self', 1.0)}::double, {s.get('humanity', 1.0)}::double, {s.get('future', 1.0)}::double)" for k, (f, _, w, cost, geo, s) in enumerate(D.FACTORS)) + ") t(ord, factor_id, weight, cost, geometric, self, humanity, future))"
_SCORES = f"""{_SIGNALS}, {_FACTORS}, scopes as (select unnest(['self', 'humanity', 'future']) as scope),
 dirs as (select direction_id, row_number() over (order by direction_id) as dord from (select distinct event_type as direction_id from events)),
 cells as (select scope, direction_id, dord, ord, factor_id, cost, geometric, weight * case scope when 'self' then self when 'humanity' then humanity else future end as fw, coalesce(ew, 0) as ew, coalesce(emean, 0) as emean, coalesce(evar, 0) as evar, coalesce(evidence_count, 0) as evidence_count
   from scopes cross join dirs cross join factors left join two using (direction_id, factor_id)),
 m as (select *, 0.1::double as pw, (0.5 * 0.1::double + emean * ew) / (0.1::double + ew) as mean, greatest(ew / (ew + 12), 0.1::double * 0.1::double / (0.1::double + ew + 1e-12)) as conf from cells),
 s as (select *, least(0.95::double, sqrt(greatest(0, (0.25 * 0.1::double + emean * emean * ew) / (0.1::double + ew) - mean * mean, evar)) + 0.45 * (1 - conf)) as spread from m),
 e as (select *, greatest(0, mean - spread / 2) as low, least(1, mean + spread / 2) as high from s),
 f as (select *, case when cost then 1 - mean else mean end as adjusted, case when cost then 1 - high else low end as robust, fw * case when cost then 1 - mean else mean end as contribution from e),
 d as (select scope, direction_id, dord, sum(contribution) / sum(fw) as additive_score, sum(fw * robust) / sum(fw) as robust_score,
   (sum(fw) filter (geometric) * exp(sum(fw * ln(greatest(0.02, adjusted))) filter (geometric) / sum(fw) filter (geometric)) + sum(contribution) filter (not geometric)) / sum(fw) as geometric_score, sum(evidence_count)::bigint as evidence_count from f group by all),
 t as (select *, 0.35 * additive_score + 0.65 * geometric_score as score from d),
 g as (select *, max(score) over (partition by scope) - score as regret, score / max(score) over (partition by scope) as relative_return, row_number() over (partition by scope order by score desc, robust_score desc, dord) as rank from t)"""


def _ranked(spark, sf):
    signals = _signals(spark, sf)
    order = F.row_number().over(Window.orderBy("direction_id")).cast("int")
    names = signals.select("direction_id").distinct().select("direction_id", F.col("direction_id").alias("direction_name"), order.alias("dord"), F.lit(False).alias("blocked"))
    return D.evaluated(signals, names, D.factor_table(spark))


@query(f"""{_SCORES} select scope, direction_id, round(score, 6) as score, round(additive_score, 6) as additive_score, round(geometric_score, 6) as geometric_score, round(robust_score, 6) as robust_score, evidence_count, rank,
 case when regret < 1e-12 then 'recommended' when regret < 0.04 then 'investigate_first' when robust_score < 0.30 and regret < 0.12 then 'too_risky' when regret > 0.20 then 'dominated' else 'permissible' end as status from g""")
def q_direction_rank(spark, sf):
    ranks = _ranked(spark, sf)[1]
    return ranks.select("scope", "direction_id", *[F.round(c, 6).alias(c) for c in ("score", "additive_score", "geometric_score", "robust_score")], "evidence_count", F.col("rank").cast("long").alias("rank"), "status")


@query(f"{_SCORES} select scope, direction_id, round(regret, 6) as regret, round(relative_return, 6) as relative_return from g")
def q_regret(spark, sf):
    return _ranked(spark, sf)[1].select("scope", "direction_id", F.round("regret", 6).alias("regret"), F.round("relative_return", 6).alias("relative_return"))


@query(f"{_SCORES} select scope, direction_id, gap, gap >= 0.02 as clear from (select *, round_even(score - lead(score) over (partition by scope order by rank), 3) as gap from g) where rank = 1")
def q_leader_gap(spark, sf):
    return D.leader_gap(_ranked(spark, sf)[1])


@query(f"""{_SCORES} select scope, direction_id, factor_id, round(mean, 6) as expected, round(low, 6) as low, round(high, 6) as high, round(conf, 6) as confidence, round(contribution, 6) as contribution from f""")
def q_factor_estimate(spark, sf):
    e = "estimate."
    return _ranked(spark, sf)[0].select("scope", "direction_id", "factor_id", *[F.round(e + c, 6).alias(c) for c in ("expected", "low", "high", "confidence")], F.round("contribution", 6).alias("contribution"))


@query(f"""{_SCORES}, top as (select f.*, g.rank, g.score from f join g using (scope, direction_id) where rank <= 2),
 c as (select scope, ord, factor_id, any_value(fw) as fw, max(case when rank = 1 then contribution end) as ca, max(case when rank = 2 then contribution end) as cb, max(high - low) as width,
   abs(max(case when rank = 1 then ew end) - max(case when rank = 2 then ew end)) as far, greatest(0, max(case when rank = 1 then score end) - max(case when rank = 2 then score end)) as gap from top group by scope, ord, factor_id),
 w as (select *, (ca - cb) / sum(fw) over (partition by scope) as delta, fw / sum(fw) over (partition by scope) as share from c), v as (select *, share * width * (0.7 + least(1, far / 10)) as voi from w)
 select scope, factor_id, round(delta, 6) as delta, round(gap, 6) as gap, round(least(1, gap / greatest(1e-9, share)), 6) as flip, round(voi, 6) as voi, row_number() over (partition by scope order by voi desc, ord) as place from v
 where abs(delta) >= greatest(0.01, gap * 0.2) or voi >= 0.04""")
def q_cruxes(spark, sf):
    return D.cruxes(*_ranked(spark, sf)).select("scope", "factor_id", *[F.round(c, 6).alias(c) for c in ("delta", "gap", "flip", "voi")], F.col("place").cast("long").alias("place"))


@query("""with e as (select p_partkey, list_sort([(p_partkey % 101) / 100.0::double, (p_partkey * 7 % 101) / 100.0::double, (p_partkey * 13 % 101) / 100.0::double]) as l, (p_size % 11) / 10.0::double as c from part)
 select p_partkey, round(greatest(0, l[2] - (l[3] - l[1]) * (0.15 + 0.35 * (1 - c))), 6) as averse, round(least(1, l[2] + greatest(0, l[3] - l[2]) * (0.1 + 0.2 * c)), 6) as seeking, round(l[2], 6) as neutral from e""")
def q_risk_adjusted(spark, sf):
    share = lambda a: (F.col("p_partkey") * a % 101) / 100.0
    e = read(spark, sf, "part").select("p_partkey", D.estimate(share(1), share(7), share(13), (F.col("p_size") % 11) / 10.0).alias("e"))
    e = e.select("p_partkey", D.ordered(F.col("e")).alias("e"))
    return e.select("p_partkey", *[F.round(D.risk_adjusted(F.col("e"), a), 6).alias(n) for n, a in (("averse", "risk_averse"), ("seeking", "risk_seeking"), ("neutral", "neutral"))])


@query(f"{_SIGNALS} select direction_id, count(distinct dep) as groups, max(w) as best from rated group by 1")
def q_claims_by_direction(spark, sf):
    x = _signals(spark, sf).select("direction_id", D.group_key().alias("dep"), D.signal_weight().alias("w"))
    return x.groupBy("direction_id").agg(F.countDistinct("dep").alias("groups"), F.max("w").alias("best"))


@query("""select event_type as direction_id, user_id::varchar as claim_id, round(max(((event_id * 11) % 97)::double / 97 * (((event_id * 13) % 89)::double / 89)), 6) as best
 from events where event_id % 5 <> 0 group by all""")
def q_decision_backing(spark, sf):
    return D.backing(_signals(spark, sf).withColumn("proposition_id", F.col("dependency_key"))).select("direction_id", "claim_id", F.round("best", 6).alias("best"))


@query("""with b as (select event_type as direction_id, user_id::varchar as id, max(((event_id * 11) % 97)::double / 97 * (((event_id * 13) % 89)::double / 89)) as best from events where event_id % 5 <> 0 group by all),
 t as (select *, row_number() over (partition by direction_id order by best desc, id) as place from b)
 select direction_id, place, id, coalesce(left(text, 200), '') as text from t left join documents on doc_id::varchar = id where place <= 4""")
def q_direction_samples(spark, sf):
    claims = read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text")
    found = D.samples(D.backing(_signals(spark, sf).withColumn("proposition_id", F.col("dependency_key"))), claims)
    return found.select("direction_id", F.col("place").cast("long").alias("place"), "id", "text")


@query("""with b as (select event_type as d, ['scale', 'neglectedness', 'tractability', 'personal_fit', 'leverage', 'career_capital', 'downside_risk', 'epistemic_robustness'][(json_extract_string(props, '$.k')::bigint % 8) + 1] as f from events),
 known as (select distinct d from b where d <> (select min(d) from b))
 select distinct 'direction' as kind, d as id from b where d not in (select d from known) union select distinct 'factor', f from b where d in (select d from known) and f in ('downside_risk', 'epistemic_robustness')""")
def q_unknown_ids(spark, sf):
    signals = _signals(spark, sf)
    least = signals.agg(F.min("direction_id").alias("least"))
    known = signals.select("direction_id").distinct().join(least, F.col("direction_id") != F.col("least")).select("direction_id")
    return D.unknown_ids(signals, known, D.factor_table(spark).where("ord < 6"))


_OPTIONS = """with criteria as (select * from (values (0, 'Gain', 1.0::double, 2.0::double, false), (1, 'Reach', 2.0, 1.0, false), (2, 'Cost', 1.5, 1.0, true)) t(j, name, weight, self, cost)),
 scopes as (select unnest(['self', 'future']) as scope), raw as (select *, ((n_nationkey * (7 + 4 * j)) % 101)::double / 101 as x, (n_nationkey + j) % 7 = 0 as missing from scopes cross join nation cross join criteria),
 est as (select *, case when missing then 0.25::double else x * 0.8::double end as l, case when missing then 0.5::double else x end as m, case when missing then 0.75::double else least(1::double, x + 0.1::double) end as h, case when scope = 'self' then weight * self else weight end as w from raw),
 sums as (select scope, n_nationkey, sum(w * case when cost then 1 - m else m end) / sum(w) as criteria, sum(w * case when cost then 1 - h else l end) / sum(w) as low, max(h - l) as width, coalesce(string_agg(name, ', ' order by j) filter (missing), '') as missing_names from est group by all),
 base as (select *, n_nationkey % 11 = 0 as blocked, case when n_nationkey % 5 = 0 then 0.1::double else 0::double end as soft, case when n_nationkey % 2 = 1 then 0.5 * criteria + 0.5 * 0.6::double * 0.5 * case when scope = 'future' then 1 else 0.5 end else criteria end as b from sums),
 t as (select *, case when blocked then 0 else greatest(0, least(1, b - soft)) end as total, case when blocked then 0 else greatest(0, least(1, low - soft)) end as robust from base),
 g as (select *, max(total) filter (not blocked) over (partition by scope) as best, max(robust) filter (not blocked) over (partition by scope) as best_robust from t), r as (select *, case when blocked then 0 else greatest(0, best - total) end as regret from g)
 select scope, n_nationkey as option_id, round(total, 6) as total_score, round(robust, 6) as robust_score, round(regret, 6) as regret, missing_names, row_number() over (partition by scope order by blocked, total desc, robust desc, n_nationkey) as rank,
 case when blocked then 'impermissible' when abs(total - best) < 1e-12 then 'recommended' when robust < 0.35 and regret < 0.08 then 'too_risky' when regret < 0.05 and width > 0.25 then 'investigate_first' when regret > 0.20 and robust <= best_robust + 0.02 then 'dominated' else 'permissible' end as status from r"""


@query(_OPTIONS)
def q_option_rank(spark, sf):
    """Nations as options with made-up criteria, estimates, constraints and outcomes."""
    n = F.col("n_nationkey")
    nations = read(spark, sf, "nation").select(n)
    criteria = spark.createDataFrame([(0, "Gain", 0, 1.0, {"self": 2.0}, False), (1, "Reach", 1, 2.0, {}, False), (2, "Cost", 2, 1.5, {}, True)], "criterion_id int, criterion_name string, cord int, weight double, scope_weights map<string,double>, cost boolean")
    scopes = spark.createDataFrame([("self", {}), ("future", {})], "scope string, beneficiaries map<string,double>")
    x = n * (F.col("criterion_id") * 4 + 7) % 101 / F.lit(101.0)
    known = nations.crossJoin(criteria.select("criterion_id")).where((n + F.col("criterion_id")) % 7 != 0)  # three criteria
    estimates = known.select(n.alias("option_id"), "criterion_id", D.estimate(x * 0.8, x, F.least(F.lit(1.0), x + 0.1), F.lit(0.5)).alias("est"))
    rule = lambda hard, every, penalty: F.struct(F.lit(hard).alias("hard"), (n % every != 0).alias("satisfied"), F.lit(penalty).alias("penalty"))
    branch = F.struct(F.lit(0.5).alias("p"), D.estimate(*map(F.lit, (0.4, 0.6, 0.8, 0.5))).alias("value"), F.lit("future").alias("scope"))
    options = nations.select(n.alias("option_id"), n.cast("string").alias("option_name"), n.alias("ord"), F.array(rule(True, 11, 0.0), rule(False, 5, 0.1)).alias("constraints"), F.filter(F.array(branch), lambda _: n % 2 == 1).alias("outcomes"))
    ranks = O.evaluated(options, criteria, estimates, scopes)[1]
    return ranks.select("scope", "option_id", *[F.round(c, 6).alias(c) for c in ("total_score", "robust_score", "regret")], F.coalesce("missing_names", F.lit("")).alias("missing_names"), F.col("rank").cast("long").alias("rank"), "status")


# Protocol -----------------------------------------------------------------------------------------------------------

@query(f"""{_EDGES}, f as (select * from edges where verified order by confidence desc, a desc, b desc limit 1)
 select a, b, confidence, note, left(x.text, 140) as text_a, x.source || '/u' as src_a, left(y.text, 140) as text_b, y.source || '/u' as src_b from f join documents x on x.doc_id = a join documents y on y.doc_id = b""")
def q_fault_ends(spark, sf):
    docs = read(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("source_id"), "text")
    sources = docs.select(F.col("source_id").alias("id"), F.concat("source_id", F.lit("/u")).alias("url")).distinct()
    return A.fault_ends(A.sharpest_fault(_edges(spark, sf)), docs, sources)


@query(f"""{_EDGES} select a, b, case when relation = 'contradicts' and a % 3 = 2 then 'same' else relation end as relation, relation = 'contradicts' or verified as verified, case when relation = 'contradicts' then 'v-2' end as verifier
 from edges where not (relation = 'contradicts' and a % 3 = 1)""")
def q_apply_verification(spark, sf):
    edges = _edges(spark, sf).select("a", "b", "relation", "verified", F.lit(None).cast("string").alias("verifier"))
    verdict = F.when(F.col("a") % 3 == 0, "confirm").when(F.col("a") % 3 == 1, "remove").otherwise("same")
    return G.apply_verification(edges, edges.where("relation = 'contradicts'").select("a", "b", "relation", verdict.alias("verdict"), F.lit("v-2").alias("verifier")))


@query(f"""{_EDGES} select case when relation = 'supports' then a else least(a, b) end as a, case when relation = 'supports' then b else greatest(a, b) end as b, relation from (select b as a, a as b, relation, (a + b) % 5 as k from edges) where k <> 0""")
def q_edge_directions(spark, sf):
    """Judged pairs, turned round; every fifth is unrelated and leaves no edge."""
    e = _edges(spark, sf)
    judged = e.select(F.col("b").alias("a"), F.col("a").alias("b"), F.when((F.col("a") + F.col("b")) % 5 == 0, "unrelated").otherwise(F.col("relation")).alias("relation"))
    return G.upsert_edges(judged.limit(0), judged).select("a", "b", "relation")


@query("select o_orderkey as id, case when o_orderkey % 3 = 0 then 'done' else o_orderstatus end as status from orders")
def q_finish_tasks(spark, sf):
    tasks = read(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    return G.finish_tasks(tasks, tasks.where("id % 3 = 0").select("id", F.lit("done").alias("result")))


@query("select o_orderkey as id from orders where o_orderstatus = 'O' and o_orderpriority = '1-URGENT' order by o_orderkey limit 50")
def q_take_batch(spark, sf):
    status = F.when(F.col("o_orderstatus") == "O", "pending").otherwise("done")
    return G.take_batch(read(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("kind"), status.alias("status")), "1-URGENT").select("id")


@query("""select status, count(*) as n from (select case when o_orderkey % 5 = 0 then 'retired' else o_orderstatus end as status from orders union all select 'refined' from orders where o_orderkey % 5 = 0) group by status""")
def q_refine(spark, sf):
    claims = read(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"))
    new = claims.where("cast(id as bigint) % 5 = 0").select(F.concat(F.lit("r"), "id").alias("id"), F.col("id").alias("refines_claim"))
    return G.refine(claims, new).groupBy("status").agg(F.count("*").alias("n"))


@query("select o_orderkey as id, split_part(o_orderpriority, '-', 1) <> split_part(o_orderstatus || '-x', '-', 1) as allowed from orders")
def q_may_verify(spark, sf):
    allowed = G.may_verify(F.col("o_orderpriority"), F.concat("o_orderstatus", F.lit("-x")))
    return read(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), allowed.alias("allowed"))


@query("select o_orderkey::varchar as id from orders where o_orderkey % 4 <> 0")
def q_missing_refine(spark, sf):
    rows = read(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    tasks = rows.where("cast(id as bigint) % 4 = 0").select(F.lit("refine").alias("kind"), F.struct(F.col("id").alias("claim_id")).alias("payload"))
    return G.missing_refine_tasks(rows, tasks)


@query("select o_orderstatus as feed, count(*) as n from orders where o_orderdate::date >= date '1996-01-01' group by 1")
def q_since(spark, sf):
    items = read(spark, sf, "orders").select(F.col("o_orderstatus").alias("feed"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("published"))
    return G.recent(items, "1996-01-01").groupBy("feed").agg(F.count("*").alias("n"))


@query("select source as feed, doc_id from (select source, doc_id, row_number() over (partition by source order by doc_id) as place from documents) where place <= length(source)")
def q_feed_limits(spark, sf):
    items = read(spark, sf, "documents").select(F.col("source").alias("feed"), "doc_id")
    limits = items.select("feed", F.length("feed").alias("limit")).distinct()
    return G.limited(items, limits, "doc_id").select("feed", "doc_id")


@query(f"""select conv_id, turn from conversations where not (regexp_matches(text, '^\\p{{Ll}}') or len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) < 5
  or regexp_replace(lower(regexp_extract(text, '^\\S+')), '[,.;:]+$', '') in {L.DANGLING_HEADS})""")
def q_pairable(spark, sf):
    return read(spark, sf, "conversations").where(~T.needs_refining(F.col("text"))).select("conv_id", "turn")


@query("select x.vec_id, round(list_cosine_similarity(x.embedding::double[], y.embedding::double[]), 6) as sim from embeddings x join embeddings y on y.vec_id = x.vec_id + 1")
def q_cosine(spark, sf):
    rows = read(spark, sf, "embeddings")
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return rows.join(after, "vec_id").select("vec_id", F.round(S.cosine(F.col("embedding"), F.col("next")), 6).alias("sim"))
