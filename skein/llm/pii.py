"""Personal data: exact patterns, and terms that disclose what the patterns protect, in DataFrame functions alone.

The patterns give the protected entities (an address, a number). All words of the corpus are counted, and those that
stand within CONTEXT_WORDS of an entity are counted with it. With N words in all, C in the contexts of entity e, n of
term t and k of these in the contexts of e, the pointwise mutual information of t and e is log(kN / nC), and e's own
information is log(N / C). Their ratio is 1 where t stands nowhere but near e. A term is a disclosure if the ratio is
at least GENERALISE and it was seen in SUPPORT different contexts of e (copies of one passage are no new evidence); it
is generalised to the kind of data that it discloses (an e-mail address, a number), or from REMOVE on removed, where it
stands near e.

Contract for odd inputs: null and empty texts have no spans; texts are read whole whatever their length; repeated rows
give equal rows, whose spans are the same; an empty table gives no rows; extra columns don't matter to the scan and
are kept by `sanitised`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, let, running, table

KINDS = ("email", "ip", "card", "phone")
#: Possessive forms of the given patterns: they match the same spans, without backtracking or deep recursion. A match
#: begins where a run of its first characters does, or where the last match ended.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": f"(?:(?<!{LOCAL})|\\G){LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:(?<![0-9])|\\G)[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Terms before and after an entity that are its context, and the characters in which they are looked for at first; where
#: these don't hold them all, the whole text is.
CONTEXT_WORDS, REACHES = 8, (160, None)
TERM = "[\\p{L}\\p{N}_]{3,}+"
SUPPORT, GENERALISE, REMOVE = 3, 0.85, 0.97
#: Rows up to which a table is broadcast; it is joined by shuffle beyond.
BROADCAST_ROWS = 200_000

ONE_SPAN = "struct<start:int,end:int,value:string>"
SPAN = f"array<{ONE_SPAN}>"
PIECE = "array<struct<start:int,end:int,shown:string>>"
MENTION = "array<struct<entity:string,context:string,words:array<struct<start:int,end:int,value:string>>>>"


def empty(kind: str) -> Column:
    return F.array().cast(kind)


def places(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of a pattern's matches, in characters from 0, end exclusive."""
    def add(at: Column, x: Column) -> tuple[Column, Column]:
        first = at + x["gap"]
        last = first + F.length(x["value"])
        return last, F.array(F.struct(first.alias("start"), last.alias("end"), x["value"].alias("value")))

    def found(inside: Column) -> Column:
        gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), 1, F.size(inside))
        return running(F.arrays_zip(gaps.alias("gap"), inside.alias("value")), F.lit(0), ONE_SPAN, add)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found)


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(f"^{BYTE}(?:\\.{BYTE}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(value, "[^0-9]", "")
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def gate(kind: str, text: Column) -> Column:
    """Cheap and never false where the pattern has a valid match."""
    return {"email": F.contains(text, F.lit("@")), "ip": text.rlike("[0-9]\\.[0-9]"), "card": text.rlike("[0-9](?:[\\x20-]?[0-9]){12}"), "phone": F.contains(text, F.lit("+"))}[kind]


def base_spans(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))

    def one(kind: str) -> Column:
        return F.when(gate(kind, text), F.filter(places(text, PATTERNS[kind]), lambda s: valid(kind, s["value"]))).otherwise(empty(SPAN))

    return {kind: one(kind) for kind in KINDS}


def entity(kind: Column, value: Column) -> Column:
    return F.concat(kind, F.lit(":"), F.when(kind.isin("email", "ip"), F.lower(value)).otherwise(F.regexp_replace(value, "[^0-9]", "")))


def mentions(text: Column, spans: dict[str, Column]) -> Column:
    """Each entity with the terms around it and a digest of the context; terms within base spans don't count."""
    everything = F.concat(*spans.values())

    def before(s: Column, reaches: tuple) -> Column:
        begin = F.greatest(F.lit(0), s["start"] - reaches[0]) if reaches[0] else F.lit(0)
        last = lambda terms: F.transform(F.slice(terms, F.greatest(F.lit(1), F.size(terms) - CONTEXT_WORDS + 1), F.lit(CONTEXT_WORDS)), lambda w: moved(w, begin))
        found = let(let(F.substring(text, begin + 1, s["start"] - begin), lambda t: F.filter(places(t, TERM), lambda w: (w["start"] > 0) | (begin == 0))), last)
        return let(found, lambda w: F.when((begin == 0) | (F.size(w) == CONTEXT_WORDS), w).otherwise(before(s, reaches[1:]))) if reaches[0] else found

    def after(s: Column, reaches: tuple) -> Column:
        reach = F.lit(reaches[0]) if reaches[0] else F.length(text)
        over = s["end"] + reach >= F.length(text)
        first = lambda terms: F.transform(F.slice(terms, F.lit(1), F.lit(CONTEXT_WORDS)), lambda w: moved(w, s["end"]))
        found = let(let(F.substring(text, s["end"] + 1, reach), lambda t: F.filter(places(t, TERM), lambda w: (w["end"] < reach) | over)), first)
        return let(found, lambda w: F.when(over | (F.size(w) == CONTEXT_WORDS), w).otherwise(after(s, reaches[1:]))) if reaches[0] else found

    def moved(w: Column, by: Column) -> Column:
        return F.struct((w["start"] + by).alias("start"), (w["end"] + by).alias("end"), F.lower(w["value"]).alias("value"))

    def around(s: Column) -> Column:
        near = F.concat(before(s, REACHES), after(s, REACHES))
        free = lambda words: F.filter(words, lambda w: ~F.exists(everything, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
        return let(near, lambda words: F.struct(entity(s["kind"], s["value"]).alias("entity"), F.md5(F.array_join(F.transform(words, lambda w: w["value"]), " ").cast("binary")).alias("context"), free(words).alias("words")))

    def of(kind: str) -> Column:
        return F.transform(spans[kind], lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))

    return F.transform(F.concat(*map(of, spans)), around)


def sized_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """big with small, which is broadcast only if it is counted to be small."""
    return big.join(F.broadcast(small) if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else small, on, how)


def scan_texts(docs: DataFrame) -> DataFrame:
    """A table: doc_id, digest of the text, base spans by kind, mentions, number of words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    spanned = docs.select("doc_id", text.alias("text")).select("doc_id", "text", *[c.alias(k) for k, c in base_spans(F.col("text")).items()])
    some = reduce(lambda a, b: a | b, [F.size(k) > 0 for k in KINDS])
    near = F.when(some, mentions(F.col("text"), {k: F.col(k) for k in KINDS})).otherwise(empty(MENTION))
    return spanned.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), *KINDS, near.alias("mentions"), F.regexp_count("text", F.lit(TERM)).cast("long").alias("words"))


def disclosures(docs: DataFrame, found: DataFrame) -> DataFrame:
    """entity, term, ratio, action of the terms that disclose an entity, from counts over all documents."""
    near = found.select(F.explode("mentions").alias("m")).select("m.entity", "m.context", F.explode("m.words").alias("w")).select("entity", "context", F.col("w.value").alias("term"))
    by_context = near.groupBy("entity", "context", "term").agg(F.count("*").alias("k"))
    pairs = checkpointed(by_context.groupBy("entity", "term").agg(F.sum("k").alias("k"), F.count("*").alias("support")))
    seen = pairs.where(F.col("support") >= SUPPORT)
    terms = seen.select("term").distinct()
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col("text")), F.lit(TERM), F.lit(0))).alias("term"))
    if terms.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        held = words.join(F.broadcast(terms), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n"))
    else:  # hot words are summed before any shuffle
        held = words.groupBy("term").agg(F.count("*").alias("n")).join(terms, "term", "left_semi")
    of_entity = pairs.groupBy("entity").agg(F.sum("k").alias("c"))
    total = found.agg(F.sum("words")).first()[0] or 0
    ratio = 1 - F.log(F.greatest(F.col("n"), F.col("k")) / F.col("k")) / F.log(F.greatest(F.lit(float(total)), F.col("c") * 2.0) / F.col("c"))
    rated = seen.join(held, "term").join(of_entity, "entity").select("entity", "term", ratio.alias("ratio")).where(F.col("ratio") >= GENERALISE)
    return rated.withColumn("action", F.when(F.col("ratio") >= REMOVE, "remove").otherwise(F.concat(F.lit("generalise "), F.substring_index("entity", ":", 1))))


def term_spans(found: DataFrame, rated: DataFrame) -> DataFrame:
    """digest and terms: array of (start, end, action) of a text's disclosing terms. Equal texts have one row."""
    near = found.where(F.size("mentions") > 0).select("digest", F.explode("mentions").alias("m")).select("digest", F.col("m.entity").alias("entity"), F.explode("m.words").alias("w")).select("digest", "entity", F.col("w.value").alias("term"), "w.start", "w.end").distinct()
    hit = sized_join(near, checkpointed(rated.select("entity", "term", "action")), ["entity", "term"])
    each = hit.groupBy("digest", "start", "end").agg(F.max("action").alias("action"))
    return checkpointed(each.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", "end", "action"))).alias("terms")))


def span_text(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = checkpointed(scan_texts(docs))
    terms = term_spans(found, disclosures(docs, found))
    base = F.concat(*[span_text(k, F.col(k)) for k in KINDS])
    more = F.coalesce(span_text("term", F.col("terms")), F.array().cast("array<string>"))
    return sized_join(found, terms, ["digest"], "left").select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.concat_ws(",", base).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", base, more).alias("spans"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """docs with every base span replaced by its kind, and disclosing terms generalised or removed."""
    found = checkpointed(scan_texts(docs))
    terms = term_spans(found, disclosures(docs, found))
    terms = F.broadcast(terms) if terms.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else terms
    whole = F.col("row.text")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.withColumn("digest", F.md5(F.coalesce(whole, F.lit("")).cast("binary"))).join(terms, "digest", "left")
    item = lambda s, shown: F.struct(s["start"].alias("start"), s["end"].alias("end"), shown.alias("shown"))
    named = lambda kind: lambda s: item(s, F.lit(f"[{kind.upper()}]"))
    base = [F.transform(spans, named(kind)) for kind, spans in base_spans(whole).items()]
    kind_of = lambda s: F.concat(F.lit("["), F.upper(F.substring_index(s["action"], " ", -1)), F.lit(" TERM]"))
    own = F.transform(F.coalesce(F.col("terms"), empty("array<struct<start:int,end:int,action:string>>")), lambda s: item(s, F.when(s["action"] == "remove", "").otherwise(kind_of(s))))
    rows = rows.withColumn("spans", F.array_sort(F.concat(*base, own)))

    def add(at: Column, s: Column) -> tuple[Column, Column]:
        piece = F.array(F.struct(at.alias("start"), s["start"].alias("end"), s["shown"].alias("shown")))
        return F.greatest(at, s["end"]), F.when(s["start"] < at, empty(PIECE)).otherwise(piece)  # what overlaps an earlier span only moves the end

    def text_of(pieces: Column) -> Column:
        """Text up to each span and what is shown for it; the rest follows the furthest end."""
        shown = F.transform(pieces, lambda p: F.concat(F.substring(whole, p["start"] + 1, p["end"] - p["start"]), p["shown"]))
        return F.concat(F.array_join(shown, ""), F.substring(whole, F.array_max(F.transform("spans", lambda s: s["end"])) + 1, F.length(whole)))

    pieces = running(F.col("spans"), F.lit(0), "struct<start:int,end:int,shown:string>", add)
    new = F.when(F.size("spans") > 0, text_of(pieces)).otherwise(whole)
    return rows.withColumn("text", new).select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
