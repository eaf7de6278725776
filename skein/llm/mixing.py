"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations alone.

Every source's documents, shuffled by a digest, form one stream of words that is read at most `epochs` times and
cut into blocks of equally many words. Points of the van der Corput sequence, mapped through the cumulative target
weights, name a source for each slot; the slots of a source, ranked, take its blocks in order.

Contract for odd inputs: null and empty texts have size 0 and are never taken; a null source is a source of its own
and comes last; repeated rows are separate rows of the stream; ties of the digest can only be rows that are equal in
the columns read, so any order gives the same rows; an empty table gives no rows; extra columns are kept out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpointed, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
EPOCHS = 2
#: Words in a block. Small blocks bring small sources near their targets.
BLOCK_WORDS = 64
#: Slots of one source that are ranked in one task, and cells of the unit interval by which points meet sources.
SLOTS_A_BUCKET, CELLS = 1 << 16, 4096
POINT_BITS = 40
#: Sources up to which the table of sources is broadcast; it is joined by shuffle beyond.
SOURCES = 10_000
#: Equal ranges of slots by which texts are ordered, and marks of all sources, at most.
RANGES, MARKS = 1024, 200_000


def word_count(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]++")), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """source, sid, source_size, target: shares by weight that stop at `epochs` times the source's size, the excess
    dealt again by weight. Sources in rising order of cap over weight are full until the level that the others can
    hold is under their own."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    rated = (
        by_source.withColumn("sid", F.row_number().over(order))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") - 1) % len(weights) + 1))
        .withColumn("cap", F.col("source_size") * epochs)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    level = Window.orderBy("ratio", "sid")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    everything = level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    leveled = (
        rated.withColumn("full_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.sum("source_size").over(everything) * share - F.col("full_before")) / F.col("weight_left"))
        .withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct(F.col("ratio"), F.col("sid"), F.col("level")))).over(everything)["level"])
    )
    return leveled.select("source", "sid", "source_size", F.least(F.col("cap").cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight")).alias("target"))


def stream(sized: DataFrame) -> DataFrame:
    """sized with the word of its source's stream at which each row begins. Two levels of running sums: within and
    over 65,536 ranges of the digest, so that a source of any size is spread over tasks."""
    keyed = sized.withColumn("bucket", F.substring("digest", 1, 4))
    inner = Window.partitionBy("sid", "bucket").orderBy("digest", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = keyed.groupBy("sid", "bucket").agg(F.sum("size").alias("held")).withColumn("base", F.coalesce(F.sum("held").over(outer), F.lit(0))).drop("held")
    return keyed.withColumn("start", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(base, ["sid", "bucket"]).withColumn("start", F.col("start") + F.col("base")).drop("bucket", "base")


def schedule(spark: SparkSession, sources: DataFrame, slots: int) -> DataFrame:
    """sid, block, slot: the block that each slot takes."""
    line = Window.orderBy("sid")
    shares = (
        sources.withColumn("all", F.sum("target").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("high", F.sum("target").over(line.rowsBetween(Window.unboundedPreceding, 0)) / F.col("all"))
        .withColumn("low", F.coalesce(F.sum("target").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) / F.col("all"))
        .where(F.col("high") > F.col("low"))
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.floor(F.col("high") * CELLS))))
        .select("sid", "low", "high", "cell")
    )
    reversed_bits = F.conv(F.reverse(F.lpad(F.bin("id"), POINT_BITS, "0")), 2, 10).cast("long")
    points = spark.range(slots).select(F.col("id").alias("slot"), (reversed_bits / F.lit(2**POINT_BITS)).alias("point")).withColumn("cell", F.floor(F.col("point") * CELLS))
    named = points.join(shares, "cell").where((F.col("low") <= F.col("point")) & (F.col("point") < F.col("high"))).select("sid", "slot", F.floor(F.col("slot") / SLOTS_A_BUCKET).alias("bucket"))
    outer = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = named.groupBy("sid", "bucket").agg(F.count("*").alias("held")).withColumn("base", F.coalesce(F.sum("held").over(outer), F.lit(0))).drop("held")
    inner = Window.partitionBy("sid", "bucket").orderBy("slot")
    return named.withColumn("rank", F.row_number().over(inner)).join(base, ["sid", "bucket"]).select("sid", (F.col("base") + F.col("rank") - 1).alias("block"), "slot")


def digest_of(doc_id: Column, size: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit("mix"), doc_id.cast("string"), size.cast("string")).cast("binary"))


def sizes(docs: DataFrame) -> DataFrame:
    size = word_count(F.col("text"))
    return docs.select("doc_id", "source", size.alias("size")).withColumn("digest", digest_of(F.col("doc_id"), F.col("size")))


def slotted(sized: DataFrame, weights: tuple[int, ...], share: float, epochs: int, block_words: int) -> tuple[DataFrame, DataFrame, int]:
    """Rows with their sources' size and target; the pieces of rows in blocks, with the words that the mix takes of each
    and the block's slot; and the number of slots."""
    spark = sized.sparkSession
    sized = checkpointed(sized)
    sources = checkpointed(targets(sized, weights, share, epochs))
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    slots = math.ceil(total / block_words)
    slots += 2 * slots.bit_length()  # what the sequence may be behind by
    of = F.broadcast(sources) if sources.count() <= SOURCES else sources
    rows = sized.join(of, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    begin = F.col("epoch") * F.col("source_size") + F.col("start")
    pieces = (
        stream(rows.where(F.col("size") > 0))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("from", begin)
        .withColumn("to", F.col("from") + F.col("size"))
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("from") / block_words), F.floor((F.col("to") - 1) / block_words))))
    )
    end = F.least(F.floor("target"), (F.col("block") + 1) * block_words)
    words = F.greatest(F.lit(0), F.least(F.col("to"), end) - F.greatest(F.col("from"), F.col("block") * block_words))
    met = pieces.join(schedule(spark, sources, slots), ["sid", "block"], "left").withColumn("words", F.when(F.col("slot").isNotNull(), words).otherwise(0))
    return rows, met, slots


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target and taken, the words that the mix takes of it, repeats
    counted."""
    rows, met, _ = slotted(sizes(docs), weights, share, epochs, block_words)
    kept = ["doc_id", "source", "size", "source_size", "target"]
    taken = met.groupBy(*kept, "sid", "start").agg(F.sum("words").alias("taken"))
    return taken.select(*kept, "taken").unionByName(rows.where(F.col("size") == 0).select(*kept, F.lit(0).cast("long").alias("taken")))


def repeated(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs as the mix orders them: a row comes once for each reading of its source's stream that takes about half of its
    words or more, and rows are partitioned and sorted by the slots that take them.

    A source's stream is read in order of digests, so a few digests a source say all: the one where its last reading ends,
    and those at which its rows come to each of up to RANGES equal ranges of slots. They are broadcast (at most MARKS), texts
    are shuffled once, to their range, and within it rows of a source stand in order and sources are interleaved by
    interpolation between its marks."""
    _, met, slots = slotted(sizes(docs), weights, share, epochs, block_words)
    read = checkpointed(met.groupBy("source", "sid", "digest", "start", "size", "epoch").agg(F.sum("words").alias("words"), F.min("slot").alias("slot")))
    times = F.floor(F.sum("words") / F.col("size") + 0.5).cast("int")
    taken = read.groupBy("source", "digest", "start", "size").agg(times.alias("times"))
    last = taken.groupBy("source").agg(F.max(F.struct("times", "digest")).alias("last"))
    ranges = max(1, min(RANGES, MARKS // max(1, epochs * last.count())))
    cell = F.floor(F.col("slot") * ranges / max(1, slots)).cast("int")
    marks = read.where(F.col("slot").isNotNull()).groupBy("source", "epoch", cell.alias("cell")).agg(F.min(number_of(F.col("digest"))).alias("low"))
    lists = marks.groupBy("source", "epoch").agg(F.array_sort(F.collect_list(F.struct("low", "cell"))).alias("marks"))  # up to RANGES
    plan = checkpointed(lists.join(last, lists["source"].eqNullSafe(last["source"])).select(lists["source"].alias("of"), "epoch", "marks", "last"))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = docs.select(row, docs["source"].alias("source"), digest_of(docs["doc_id"], word_count(docs["text"])).alias("digest"), word_count(docs["text"]).alias("size"))
    met_ = rows.where(F.col("size") > 0).join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("of")))
    again = F.when(F.col("digest") <= F.col("last.digest"), F.col("last.times")).otherwise(F.col("last.times") - 1)
    at = number_of(F.col("digest"))
    before = F.filter("marks", lambda m: m["low"] <= at)
    here = F.coalesce(F.try_element_at(before, F.lit(-1)), F.get("marks", F.lit(0)))
    chosen = met_.where(F.col("epoch") < again).withColumn("here", here).withColumn("next", F.coalesce(F.get("marks", F.size(before))["low"], F.lit(float(1 << 52))))
    placed = chosen.withColumn("place", F.col("here.cell") + F.least(F.lit(0.999999), F.greatest(F.lit(0.0), (at - F.col("here.low")) / F.greatest(F.lit(1.0), F.col("next") - F.col("here.low")))))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.select("row", "place", "source").repartitionById(tasks, F.floor(F.col("place") * tasks / ranges).cast("int")).sortWithinPartitions("place", "source")
    return dealt.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def number_of(digest: Column) -> Column:
    """The first 52 bits of a digest, which a double holds exactly."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = """
with sized as (
  select doc_id, source, size, md5(concat_ws(':', 'mix', cast(doc_id as varchar), cast(size as varchar))) as digest
  from (select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^ \\x09-\\x0D]+')), 0) as bigint) as size from documents)),
rated as (
  select *, 2 * source_size as cap, (2 * source_size)::double / weight as ratio from (
    select source, source_size, row_number() over (order by source nulls last) as sid, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
    from (select source, sum(size)::bigint as source_size from sized group by source))),
leveled as (
  select *, ((sum(source_size) over ())::double * 1.5 - coalesce(sum(cap) over (order by ratio, sid rows between unbounded preceding and 1 preceding), 0)::double)
    / (sum(weight) over () - coalesce(sum(weight) over (order by ratio, sid rows between unbounded preceding and 1 preceding), 0))::double as level
  from rated),
sources as (
  select source, sid, source_size, least(cap::double, coalesce((select arg_min(level, (ratio, sid)) from leveled where ratio >= level), 0) * weight) as target from leveled),
line as (
  select *, sum(target) over (order by sid) / sum(target) over () as high,
    coalesce(sum(target) over (order by sid rows between unbounded preceding and 1 preceding), 0) / sum(target) over () as low from sources),
plan as (select n + 2 * length(bin(n)) as slots from (select ceil(sum(target) / 64)::bigint as n from sources)),
points as (select slot, list_sum(list_transform(range(40), lambda i: ((slot >> i) & 1) * (1::bigint << (39 - i))))::double / (1::bigint << 40) as point
  from (select unnest(range(slots)) as slot from plan)),
taken_blocks as (select sid, row_number() over (partition by sid order by slot) - 1 as block from points join line on low <= point and point < high),
streams as (
  select s.doc_id, s.size, t.sid, t.source_size, t.target, sum(s.size) over (partition by t.sid order by s.digest, s.doc_id, s.size rows unbounded preceding)::bigint - s.size as start
  from sized s join sources t on s.source is not distinct from t.source),
parts as (
  select *, e * source_size + start as a, e * source_size + start + size as b from streams, (values (0), (1)) v(e) where size > 0),
pieces as (select *, unnest(range(a // 64, (b - 1) // 64 + 1)) as block from parts)
select doc_id, size, source_size, target, sum(case when k.block is null then 0 else greatest(0, least(b, least(floor(target)::bigint, (p.block + 1) * 64)) - greatest(a, p.block * 64)) end)::bigint as taken
from pieces p left join taken_blocks k on k.sid = p.sid and k.block = p.block group by p.sid, p.start, doc_id, size, source_size, target
union all select doc_id, size, source_size, target, 0 from streams where size = 0
"""
