"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters, each pair verified once.

A document's set holds 64-bit hashes of its distinct 5-word shingles, of which 56 bits are kept; documents of equal sets
form a class, named by 128 bits of sums over the set. All of the work below is on classes, so copies are never paired.

1. Chunks of documents send their shingles to buckets, sorted and packed. A bucket counts each shingle over all chunks and
   answers with those that stand in two sets or more. A shingle that many sets of one chunk hold is sent as one count.
2. A class that shares less than three quarters of its set can't link; the others keep their shared shingles in the order
   of these counts, rare first, the unshared ones ahead of them. Both steps are done again with what is left, when equal
   sets have met.
3. Rows of the prefixes that share a shingle and pass the length and positional filters are candidates. At first only one
   class of each shingle and length meets the others; what these links join needs no more pairs. All pairs of different
   components that still share a prefix shingle follow, so no link that changes a component is lost.
4. Candidates are verified on whole sets, once a pair, after the suffix filter.

`near_duplicates` seeks only links that change a component: component_id is exact, pairs inside a component that were not
needed to find it are neither verified nor counted. `similar_pairs` verifies and returns all pairs of classes.

Contract for odd inputs: null and empty texts and texts without words have empty sets and link with nothing; fewer than
five words are one shingle; texts of any length are read whole; repeated rows are members of one class; equal counts are
ordered by shingle; a null doc_id is never a component's id unless all of its are null; an empty table gives no rows;
extra columns don't matter. Documents are read twice and must come in the same order both times, as from a stored table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, arrow_rows, checkpointed, chunks, lean, lower_ascii, mix64, table, text_bytes, token_hashes, token_spans
from .components import components

WORDS, PERCENT = 5, 75
#: Bits of a hash that are kept; the eight above them take the level of its count.
TOKEN_BITS = 56
TOKEN = np.uint64((1 << TOKEN_BITS) - 1)
#: Shingles and classes of a chunk, and shingles of a bucket on average: what one task sorts at once.
CHUNK, CHUNK_CLASSES, BUCKET = 1 << 20, 60_000, 1 << 20
#: Sets of one chunk from which a shingle of theirs is sent as a count.
MANY = 32
#: Stands for "all of the chunk's sets that the chunk knows to hold it".
ALL = 0xFFFF
#: Parts of a set that the suffix filter compares.
PARTS = 16
#: Rows up to which ids to leave out are broadcast; they are joined by shuffle beyond.
BROADCAST_ROWS = 200_000
PACKED = "bucket int, chunk long, tokens binary, refs binary, counts binary, names binary"


def needed(sizes: np.ndarray) -> np.ndarray:
    """Least overlap of two sets whose sizes sum to `sizes`: ceil(t / (100 + t) * sizes)."""
    return -(-PERCENT * sizes // (100 + PERCENT))


def sort_within(x: np.ndarray, offs: np.ndarray) -> None:
    """Sorts each row's part of x in place."""
    for i, j in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        x[i:j].sort()


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, hashes): sorted distinct shingles of some rows of a text column."""
    buf, offs = text_bytes(column)
    for a, b in chunks(offs):
        part, at = lower_ascii(buf[offs[a] : offs[b]]), offs[a : b + 1] - offs[a]
        starts, ends, row = token_spans(part, at)
        words = token_hashes(part, starts, ends)
        counts = np.bincount(row, minlength=b - a)
        first = np.concatenate([[0], np.cumsum(counts)])
        few = np.flatnonzero((counts > 0) & (counts < WORDS))
        with np.errstate(over="ignore"):
            n = max(0, len(words) - WORDS + 1)
            mixed = np.zeros(n, np.uint64)
            for k in range(WORDS):
                mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
            whole = row[:n] == row[WORDS - 1 :] if n else np.zeros(0, bool)
            hashes, owner = mix64(mixed[whole]), row[:n][whole]
            if len(few):
                short = [mix64(np.array([np.sum(words[first[i] : first[i + 1]] * np.arange(3, 3 + 2 * counts[i], 2, dtype=np.uint64)) + np.uint64(counts[i])]))[0] for i in few]
                hashes, owner = np.concatenate([hashes, np.array(short, np.uint64)]), np.concatenate([owner, few])
        by = np.argsort(owner, kind="stable") if len(few) else slice(None)
        hashes, owner = hashes[by] & TOKEN, owner[by]
        sort_within(hashes, np.searchsorted(owner, np.arange(b - a + 1)))
        if len(hashes):
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
            hashes, owner = hashes[new], owner[new]
        yield a, np.searchsorted(owner, np.arange(b - a + 1)), hashes


def class_names(offs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Two 64-bit words that name each set; zeros stand for the empty one."""
    out = np.zeros((len(offs) - 1, 2), np.uint64)
    n = np.diff(offs).astype(np.uint64)
    with np.errstate(over="ignore"):
        for k, salt in enumerate((0xA0761D6478BD642F, 0xE7037ED1A0B428DB)):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(hashes ^ np.uint64(salt)), dtype=np.uint64)])
            out[:, k] = mix64(sums[offs[1:]] - sums[offs[:-1]] + n)
    out[n == 0] = 0
    return out


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n, hi, lo: the size and the name of each row's set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, offs, hashes in shingle_sets(batch.column(1)):
                names = class_names(offs, hashes).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a : a + len(names)], pa.array(np.diff(offs).astype(np.int64)), pa.array(names[:, 0]), pa.array(names[:, 1])], names=["doc_id", "n", "hi", "lo"])

    arrow_rows(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, n long, hi long, lo long")


# Chunks and buckets.


def _pack(sorted_: np.ndarray) -> bytes:
    """Rising numbers: the first, the width of a step, and the steps in as few bytes as hold the largest."""
    steps = np.diff(sorted_)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return sorted_[:1].tobytes() + bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(data) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    width = int(raw[8])
    steps = np.zeros(((len(raw) - 9) // width, 8), np.uint8)
    steps[:, :width] = raw[9:].reshape(-1, width)
    out = np.empty(len(steps) + 1, np.uint64)
    out[0] = raw[:8].view(np.uint64)[0]
    np.cumsum(steps.view("<u8").ravel(), out=out[1:])
    out[1:] += out[0]
    return out


#: A set's name and size; a shingle that many sets of a chunk hold.
NAME = np.dtype([("hi", "<u8"), ("lo", "<u8"), ("n", "<i4")])
COUNT = np.dtype([("token", "<u8"), ("count", "<u4")])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["bucket", "chunk", "tokens", "refs", "counts", "names"])


def _chunk_rows(names: np.ndarray, sizes: np.ndarray, tokens: np.ndarray, owner: np.ndarray, buckets: int, salt: int) -> Iterator[pa.RecordBatch]:
    """The rows of a chunk: for each bucket its tokens with the sets that hold them, and counts of those that many sets
    hold; and one row of the chunk's own, with the sets' names and the sets of such tokens."""
    chunk = int.from_bytes(hashlib.blake2b(names.tobytes() + salt.to_bytes(8, "little"), digest_size=8).digest(), "little", signed=True)
    order = np.argsort(tokens)
    tokens, owner = tokens[order], owner[order].astype("<u2")
    start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    held = np.diff(np.append(start, len(tokens)))
    many = held >= MANY
    counts = np.zeros(int(many.sum()), COUNT)
    counts["token"], counts["count"] = tokens[start[many]], held[many]
    own = np.zeros(len(names), NAME)
    own["hi"], own["lo"], own["n"] = names[:, 0], names[:, 1], sizes
    direct = np.repeat(many, held)
    yield _rows([(chunk % buckets, chunk, tokens[direct].tobytes(), owner[direct].tobytes(), None, own.tobytes())])
    tokens, owner = tokens[~direct], owner[~direct]
    edges = np.array([-((-i << TOKEN_BITS) // buckets) for i in range(buckets)], np.uint64)
    cut, cut_counts = (np.append(np.searchsorted(x, edges), len(x)).tolist() for x in (tokens, counts["token"]))
    rows = []
    for k in range(buckets):
        i, j, a, b = cut[k], cut[k + 1], cut_counts[k], cut_counts[k + 1]
        if i < j or a < b:
            rows.append((k, chunk, _pack(tokens[i:j]) if i < j else None, owner[i:j].tobytes(), counts[a:b].tobytes(), None))
        if len(rows) == 64:
            yield _rows(rows)
            rows = []
    if rows:
        yield _rows(rows)


def _packed(sets: DataFrame, read, buckets: int) -> DataFrame:
    """Rows PACKED of all chunks. read gives (names, sizes, offsets, tokens) of the sets of a batch; a set comes once
    from every task that meets it."""

    def run(batches):
        seen: set[bytes] = set()
        held: list[tuple] = []
        salt = TaskContext.get().partitionId()

        def flush():
            if held:
                names, sizes, counts, tokens = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                yield from _chunk_rows(names, sizes, tokens, np.repeat(np.arange(len(names)), counts), buckets, salt)

        for batch in batches:
            for names, sizes, offs, tokens in read(batch) if batch.num_rows else ():
                fresh = np.zeros(len(names), bool)
                for i, (name, n) in enumerate(zip(names, sizes.tolist(), strict=True)):
                    key = name.tobytes()
                    if n and key not in seen:
                        seen.add(key)
                        fresh[i] = True
                counts = np.diff(offs)
                held.append((names[fresh], sizes[fresh], counts[fresh], tokens[np.repeat(fresh, counts)]))
                if sum(len(x[3]) for x in held) >= CHUNK or sum(len(x[0]) for x in held) >= CHUNK_CLASSES:
                    yield from flush()
        yield from flush()

    return sets.mapInArrow(lean(run), PACKED)


def _of_texts(batch: pa.RecordBatch) -> Iterator[tuple]:
    for _, offs, hashes in shingle_sets(batch.column(0)):
        yield class_names(offs, hashes), np.diff(offs), offs, hashes


def _of_sets(batch: pa.RecordBatch) -> Iterator[tuple]:
    names = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1).view(np.uint64)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) & TOKEN for x in batch.column(3)]
    yield names, batch.column(2).to_numpy(), np.concatenate([[0], np.cumsum([len(x) for x in sets])]), np.concatenate(sets)


def _groups(batches, column: int) -> Iterator[list[dict]]:
    """Runs of rows with one value in a column, by which they are sorted."""
    held, of = [], None
    for batch in batches:
        for row in zip(*(batch.column(i) for i in range(batch.num_columns)), strict=True):
            key = row[column].as_py()
            if key != of and held:
                yield held
                held = []
            of = key
            held.append(row)
    if held:
        yield held


def level(counts: np.ndarray) -> np.ndarray:
    """Eight levels for each doubling of the count, so that rare shingles come first."""
    return np.minimum(8 * np.log2(counts), 255).astype(np.uint64)


def _answers(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["chunk", "keys", "refs", "names"])


def _counted(packed: DataFrame, buckets: int, tasks: int) -> DataFrame:
    """chunk, keys, refs, names: what each chunk holds of the shingles that several sets have, as level and token, with
    the number of the set; rows with names pass."""

    def run(batches):
        for rows in _groups(batches, 0):
            tokens, refs, row, weights = [], [], [], []
            own = [(chunk.as_py(), x.as_py(), f.as_py(), names.as_py()) for _, chunk, x, f, _, names in rows if names.is_valid]
            if own:
                yield _answers(own)
            for k, (_, _, packed_, refs_, counts, names) in enumerate(rows):
                if names.is_valid:
                    continue
                if packed_.is_valid:
                    tokens.append(_unpack(packed_.as_buffer()))
                    refs.append(np.frombuffer(refs_.as_buffer(), "<u2"))
                    row.append(np.full(len(tokens[-1]), k))
                    weights.append(np.ones(len(tokens[-1]), np.int64))
                many = np.frombuffer(counts.as_buffer(), COUNT)
                tokens.append(many["token"])
                refs.append(np.full(len(many), ALL, "<u2"))
                row.append(np.full(len(many), k))
                weights.append(many["count"].astype(np.int64))
            if not tokens:
                continue
            t, f, r, w = (np.concatenate(x) for x in (tokens, refs, row, weights))
            order = np.argsort(t)
            t = t[order]
            start = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            total = np.add.reduceat(w[order], start)
            shared = np.repeat(total > 1, np.diff(np.append(start, len(t))))
            keys = ((np.repeat(level(total), np.diff(np.append(start, len(t)))) << np.uint64(TOKEN_BITS)) | t)[shared]
            at = order[shared]
            by = np.argsort(r[at], kind="stable")
            keys, f, r = keys[by], f[at][by], r[at][by]
            cut = np.searchsorted(r, np.arange(len(rows) + 1)).tolist()
            out = [(rows[k][1].as_py(), keys[i:j].tobytes(), f[i:j].tobytes(), None) for k, (i, j) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if i < j]
            for k in range(0, len(out), 64):
                yield _answers(out[k : k + 64])

    dealt = packed.repartitionById(tasks, F.col("bucket") % tasks).sortWithinPartitions("bucket")
    return dealt.mapInArrow(lean(run), "chunk long, keys binary, refs binary, names binary")


def _gathered(answers: DataFrame, tasks: int) -> DataFrame:
    """hi, lo, n, keys: the shared shingles, rare first, of each set of a chunk that shares enough to be linked."""

    def run(batches):
        for rows in _groups(batches, 0):
            own = next((x for x in rows if x[3].is_valid), None)
            if own is None:
                raise RuntimeError("a chunk was made twice with other rows: documents must come in a fixed order")
            names = np.frombuffer(own[3].as_buffer(), NAME)
            keys, refs = (np.concatenate([np.frombuffer(x[k].as_buffer(), t) for x in rows if not x[3].is_valid] or [np.zeros(0, t)]) for k, t in ((1, np.uint64), (2, "<u2")))
            many = np.sort(keys[refs == ALL] & TOKEN)
            leveled = keys[refs == ALL][np.argsort(keys[refs == ALL] & TOKEN)]
            direct = np.frombuffer(own[1].as_buffer(), np.uint64)
            keys, refs = np.concatenate([keys[refs != ALL], leveled[np.searchsorted(many, direct)]]), np.concatenate([refs[refs != ALL], np.frombuffer(own[2].as_buffer(), "<u2")])
            counts = np.bincount(refs, minlength=len(names))
            kept = 100 * counts >= PERCENT * names["n"].astype(np.int64)
            order = np.lexsort((keys, refs))
            keys, cut = keys[order], np.concatenate([[0], np.cumsum(counts)])
            at = np.flatnonzero(kept)
            for k in range(0, len(at), 256):
                some = at[k : k + 256]
                yield pa.RecordBatch.from_arrays([pa.array(names["hi"][some].view(np.int64)), pa.array(names["lo"][some].view(np.int64)), pa.array(names["n"][some]), pa.array([keys[cut[i] : cut[i + 1]].tobytes() for i in some.tolist()], pa.binary())], names=["hi", "lo", "n", "keys"])

    dealt = answers.repartitionById(tasks, F.pmod("chunk", F.lit(tasks)).cast("int")).sortWithinPartitions("chunk")
    return dealt.mapInArrow(lean(run), "hi long, lo long, n int, keys binary")


def shared(docs: DataFrame, shingles: int) -> DataFrame:
    """hi, lo, n, keys of the classes that can link, once each; `shingles` is about how many all sets hold."""
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = tasks * -(-shingles // (BUCKET * tasks)) if shingles else tasks
    arrow_rows(docs.sparkSession)
    found = _gathered(_counted(_packed(docs.select("text"), _of_texts, buckets), buckets, tasks), tasks)
    met = found.repartition(tasks, "hi", "lo")  # equal sets of several chunks come to one task, which sends one on
    return _gathered(_counted(_packed(met, _of_sets, buckets), buckets, tasks), tasks)


# Candidates and their verification.


def _prefixes(kept: DataFrame) -> DataFrame:
    """token, node, n, pos: the shared shingles in each class's prefix, with their place in the set; unshared ones come
    first and are left out."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(2)]
            n, m = batch.column(1).to_numpy().astype(np.int64), np.array([len(x) for x in keys], np.int64)
            take = np.maximum(0, n - (-(-PERCENT * n // 100)) + 1 - (n - m))
            pos = np.concatenate([np.arange(a, a + b) for a, b in zip((n - m).tolist(), take.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[:k] for x, k in zip(keys, take.tolist(), strict=True)]).view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), take)), pa.array(np.repeat(n, take).astype(np.int32)), pa.array(pos.astype(np.int32))], names=["token", "node", "n", "pos"])

    return kept.select("node", "n", "keys").mapInArrow(lean(run), "token long, node long, n int, pos int")


def _close(x: str, y: str) -> Column:
    """Length and positional filters of two rows that share a shingle: if it is the first that they share, what is left
    of either set, itself included, bounds their overlap. Similar sets pass at least at their first shared shingle."""
    of = lambda k, c: F.col(f"{k}.{c}").cast("long")
    left = F.least(of(x, "n") - of(x, "pos"), of(y, "n") - of(y, "pos"))
    return (100 * F.least(of(x, "n"), of(y, "n")) >= PERCENT * F.greatest(of(x, "n"), of(y, "n"))) & (left * (100 + PERCENT) >= PERCENT * (of(x, "n") + of(y, "n")))


def _pair(x: str, y: str) -> tuple[Column, Column]:
    return F.least(f"{x}.node", f"{y}.node").alias("u"), F.greatest(f"{x}.node", f"{y}.node").alias("v")


def _led(rows: DataFrame, order: Column) -> DataFrame:
    """Pairs of each class of a shingle with the first, in the given order, of those of about its length. Classes of one
    root need no pair."""
    banded = rows.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / np.log(100 / PERCENT)))
    first = banded.groupBy("token", "band").agg(F.min(F.struct(order.alias("order"), "node", "n", "pos", "root")).alias("y"), F.min("root").alias("low"), F.max("root").alias("high"))
    first = first.where(F.col("low") < F.col("high")).select(F.col("token").alias("of"), F.col("band").alias("in"), "y.node", "y.n", "y.pos", "y.root").alias("y")
    met = banded.alias("x").join(first, (F.col("x.token") == F.col("y.of")) & (F.col("x.band") == F.col("y.in")) & (F.col("x.root") != F.col("y.root")) & _close("x", "y"))
    return met.select(*_pair("x", "y")).distinct()


def _across(rows: DataFrame) -> DataFrame:
    """All candidates of different components. Of two such rows of a shingle one at least is outside the component that
    has most rows of it, so only those outside meet the others."""
    held = rows.groupBy("token", "root").count().groupBy("token").agg(F.max(F.struct("count", "root")).alias("most"), F.count("*").alias("roots"))
    mixed = rows.join(held.where("roots > 1").select("token", F.col("most.root").alias("main")), "token")
    x, y = mixed.where(F.col("root") != F.col("main")).alias("x"), mixed.alias("y")
    once = (F.col("y.root") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    return x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & once & _close("x", "y")).select(*_pair("x", "y")).distinct()


def overlap(x: np.ndarray, y: np.ndarray, least: int) -> int:
    """How many numbers two sorted sets share, or 0 if the suffix filter shows that it is less than `least`: parts of x
    share no more with the parts of y between the same bounds than the smaller one holds."""
    edges = np.arange(1, PARTS) * len(x) // PARTS
    ours, theirs = (np.diff(np.concatenate([[0], at, [n]])) for at, n in ((edges, len(x)), (np.searchsorted(y, x[edges]), len(y))))
    if np.minimum(ours, theirs).sum() < least:
        return 0
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    return int((x[at] == y).sum())


def _verified(kept: DataFrame, pairs: DataFrame) -> DataFrame:
    """u, v, both, n_u, n_v of the pairs whose sets are similar; both: the size of their intersection."""

    def run(batches):
        for batch in batches:
            n = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
            least = needed(n)
            both = np.array([overlap(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), k) for x, y, k in zip(batch.column(4), batch.column(5), least.tolist(), strict=True)], np.int64)
            ok = pa.array(both >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok), pa.array(both).filter(ok), batch.column(2).filter(ok), batch.column(3).filter(ok)], names=["u", "v", "both", "n_u", "n_v"])

    of = lambda k: kept.select(F.col("node").alias(k), F.col("n").alias(f"n_{k}"), F.col("keys").alias(f"keys_{k}"))
    two = pairs.join(of("u"), "u").join(of("v"), "v").select("u", "v", "n_u", "n_v", "keys_u", "keys_v")
    return two.mapInArrow(lean(run), "u long, v long, both long, n_u int, n_v int")


def _rooted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    labels = F.broadcast(labels) if labels.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else labels
    return rows.drop("root").join(labels, rows["node"] == labels["node"], "left").select(*[rows[c] for c in ("token", "node", "n", "pos")], F.coalesce(labels["root"], rows["node"]).alias("root"))


class _Sets:
    """What the join works on: rows of documents, the classes that can link, and the rows of their prefixes."""

    def __init__(self, tmp: Scratch, docs: DataFrame):
        self.rows = tmp.stored(classes(docs), "jaccard-classes")
        shingles = self.rows.agg(F.sum("n")).first()[0] or 0
        kept = shared(docs, shingles).withColumn("node", F.monotonically_increasing_id())
        self.kept = tmp.stored(kept, "jaccard-sets")  # the numbers hold once they are written
        self.prefixes = tmp.stored(_prefixes(self.kept), "jaccard-prefixes")


def _labels(sets: _Sets) -> DataFrame:
    """node and root of all classes that are linked with another."""
    rows = sets.prefixes.withColumn("root", F.col("node"))
    tried = checkpointed(_led(rows, F.col("pos") / F.col("n")))
    links = checkpointed(_verified(sets.kept, tried).select("u", "v"))
    for find in (lambda x: _led(x, F.xxhash64(F.lit(1), "node")), _across):
        rows = _rooted(sets.prefixes, checkpointed(components(links)))
        pairs = checkpointed(find(rows).join(tried, ["u", "v"], "left_anti"))
        links = checkpointed(links.unionByName(_verified(sets.kept, pairs).select("u", "v")))
        tried = tried.unionByName(pairs)
    return checkpointed(components(links))


def _members(sets: _Sets) -> DataFrame:
    """doc_id, n, hi, lo, key_hi, key_lo: each row with its component's name, that of one of its classes."""
    names = sets.kept.select("node", "hi", "lo")
    roots = names.select(F.col("node").alias("root"), F.col("hi").alias("key_hi"), F.col("lo").alias("key_lo"))
    linked = _labels(sets).join(names, "node").join(roots, "root").select("hi", "lo", "key_hi", "key_lo")
    return sets.rows.join(linked, ["hi", "lo"], "left").select("doc_id", "n", "hi", "lo", F.coalesce("key_hi", "hi").alias("key_hi"), F.coalesce("key_lo", "lo").alias("key_lo"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of each row."""
    with Scratch(docs.sparkSession) as tmp:
        rows = _members(_Sets(tmp, docs))
        some = rows.where(F.col("n") > 0)
        least = some.groupBy("key_hi", "key_lo").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows"))
        grouped = least.where(F.col("rows") > 1).drop("rows")
        found = some.join(grouped, ["key_hi", "key_lo"], "left").select("doc_id", "n", F.coalesce("component_id", "doc_id").alias("component_id"))
        out = found.unionByName(rows.where(F.col("n") == 0).select("doc_id", "n", F.col("doc_id").alias("component_id")))
        return checkpointed(out.withColumnRenamed("n", "n_shingles"))


def similar_pairs(docs: DataFrame) -> DataFrame:
    """left_id, right_id, both, n_left, n_right: all pairs of different sets that are similar, named by the least doc_id
    that has them, with the sizes of the sets and of their intersection. As many rows as there are such pairs."""
    with Scratch(docs.sparkSession) as tmp:
        sets = _Sets(tmp, docs)
        x, y = sets.prefixes.alias("x"), sets.prefixes.alias("y")
        pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node")) & _close("x", "y")).select(*_pair("x", "y")).distinct()
        least = sets.rows.groupBy("hi", "lo").agg(F.min("doc_id").alias("id")).join(sets.kept.select("node", "hi", "lo"), ["hi", "lo"])
        of = lambda k, name: least.select(F.col("node").alias(k), F.col("id").alias(name))
        named = _verified(sets.kept, pairs).join(of("u", "left_id"), "u").join(of("v", "right_id"), "v")
        return checkpointed(named.select("left_id", "right_id", "both", F.col("n_u").alias("n_left"), F.col("n_v").alias("n_right")))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all columns, of which one a component stays: the one of least doc_id, and of rows that
    repeat it the one whose set has the least name. Rows without words stay."""
    found = near_duplicates(docs)
    odd = found.groupBy("doc_id").count().where((F.col("count") > 1) | F.col("doc_id").isNull()).limit(1).count()
    if odd:
        return _representatives_by_set(docs)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("jaccard gone")).distinct()
    small = gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if small else gone, docs["doc_id"] == gone["jaccard gone"], "left_anti")


def _representatives_by_set(docs: DataFrame) -> DataFrame:
    """As representatives, where ids are repeated or null: rows are told apart by id and set."""
    with Scratch(docs.sparkSession) as tmp:
        rows = checkpointed(_members(_Sets(tmp, docs)))
    stays = rows.where(F.col("n") > 0).groupBy("key_hi", "key_lo").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hi", "lo")).alias("least"))
    stays = checkpointed(stays.select(F.col("least.doc_id").alias("jaccard id"), F.col("least.hi").alias("jaccard hi"), F.col("least.lo").alias("jaccard lo")))
    at = docs.columns.index("text")

    def named(batches):
        for batch in batches:
            for a, offs, hashes in shingle_sets(batch.column(at)):
                names = class_names(offs, hashes).view(np.int64)
                part = batch.slice(a, len(names))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(np.diff(offs))], names=[*batch.schema.names, "jaccard hi of", "jaccard lo of", "jaccard n of"])

    whole = docs.mapInArrow(lean(named), docs.select("*", *[F.lit(0).cast("long").alias(f"jaccard {c} of") for c in ("hi", "lo", "n")]).schema)
    empty = whole.where(F.col("jaccard n of") == 0).select(*[whole[c] for c in docs.columns])
    met = whole.where(F.col("jaccard n of") > 0).join(stays, whole["doc_id"].eqNullSafe(stays["jaccard id"]) & (whole["jaccard hi of"] == stays["jaccard hi"]) & (whole["jaccard lo of"] == stays["jaccard lo"]), "left_semi")
    one = met.dropDuplicates(["doc_id", "jaccard hi of", "jaccard lo of"])
    return one.select(*[one[c] for c in docs.columns]).unionByName(empty)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
