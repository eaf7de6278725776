"""Each operator against brute force or an exact round trip, with nulls, empty and long texts, ties, repeats, empty tables
and extra columns."""

import collections
import hashlib
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import bpe, jaccard, jpeg, language, licenses, media, mixing, pii, quality, toxicity

WORDS = "green apples taste fine but blue pears are often better when they come late in the year and cost less".split()


def texts():
    rng = np.random.default_rng(3)
    long = " ".join(rng.choice(WORDS, 3000))
    base = [" ".join(rng.choice(WORDS, 60)) for _ in range(6)]
    out = [None, "", "  \t\n", "one two", "ONE  two", *base, *base[:2], long, long + " end"]
    for k in range(12):  # near copies of one text
        w = base[0].split()
        w[5 * k % 60] = f"new{k}"
        out.append(" ".join(w))
    return out


def table(spark, rows=None, extra=True):
    rows = texts() if rows is None else rows
    df = spark.createDataFrame([(k, t, "en", f"s{k % 3}" if k % 7 else None, 0) for k, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    # names that the operators use inside
    return df.withColumns({c: F.lit("x") for c in ("size", "target", "token", "score", "class", "entity", "line", "block")}) if extra else df


def empty(spark):
    return table(spark, [], False).limit(0)


def brute_pii(text):
    found = []
    kinds = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
    for kind, pattern in kinds:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            twice = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits)))
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 13 <= len(digits) <= 19 and twice % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                found.append((kind, m.start(), m.end()))
    return found


ODD = [None, "", "a@b.com.@c.d a@b.com_x@y.z @x.y a@b..c %@-.-", "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.0255", "4111 1111-1111 1111 x 41111111111111115", "+1 (988) 555-2485++12 345678901 +1-+1", "é👩a@b.co 👩 +49 30 1234567", "1" * 20000, "a" * 20000 + "@" + "b.c" * 5000, "no data"]


def test_pii_spans(spark):
    got = {r.doc_id: [(k, s.start, s.end) for k in pii.KINDS for s in r[k]] for r in pii.scan_texts(table(spark, ODD)).collect()}
    assert got == {k: brute_pii(t) for k, t in enumerate(ODD)}


def test_pii_disclosure(spark):
    rows = [f"variant{k} of zanzibarwho writes from ann@mail.org since part{k}" for k in range(5)] + ["the of from since writes " * 3] * 20 + [None, ""]
    docs = table(spark, rows)
    found = pii.scan_texts(docs)
    rated = {r.term: r.action for r in pii.disclosures(docs, found).collect()}
    assert rated.get("zanzibarwho") == "remove" and "since" not in rated
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert "ann@" not in clean[0] and "zanzibarwho" not in clean[0] and "[EMAIL]" in clean[0]
    assert clean[5] == rows[5] and clean[25] is None and clean[26] == ""
    assert pii.sanitised(docs).columns == docs.columns and pii.sanitised(empty(spark)).count() == 0


def test_quality_learns(spark):
    good = [" ".join(np.random.default_rng(k).choice(WORDS, 40)) for k in range(200)]
    bad = [" ### ".join(np.random.default_rng(k).choice(WORDS, 40)) for k in range(200)] + ["same same same same " * 9] * 20
    docs = table(spark, [*good, *bad, None, ""])
    labels = spark.createDataFrame([(k, int(k < 200)) for k in range(0, 420, 2)] + [(9999, 1), (None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.scored(docs, model, ["doc_id"], 5, 0).collect()}
    assert np.mean([got[k].predicted == int(k < 200) for k in range(1, 420, 2)]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values()) and got[0].held_out == (zlib.crc32(b"0") % 5 == 0)
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.predicted}
    assert quality.accepted(empty(spark), model).count() == 0
    none = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.scored(docs, none, ["doc_id"], 5, 0).collect()} == {0.5}


def test_toxicity_learns(spark):
    rng = np.random.default_rng(1)
    clean = [" ".join(rng.choice(WORDS, 50)) for _ in range(300)]
    toxic = [t + " " + " ".join(rng.choice(["idiot", "loser", "vequtre", "vequmon", "scum", "vequlai"], 3)) for t in clean[:150]]
    docs = table(spark, [*clean, *toxic, None, "", "vequnew is here"])
    labels = spark.createDataFrame([(k, int(k >= 300)) for k in range(0, 450) if k % 3], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in quality.scored(docs, model, ["doc_id"], 4, 2).collect()}
    assert np.mean([got[k].predicted == int(k >= 300) for k in range(0, 450, 3)]) > 0.95
    assert got[450].predicted == 0 and got[451].predicted == 0


def test_label_model_weighs_voters():
    rng = np.random.default_rng(0)
    y = rng.random(2000) < 0.3
    noisy = np.where(rng.random(2000) < 0.4, ~y, y)
    good = [np.where(rng.random(2000) < 0.1, ~y, y) for _ in range(3)]
    votes = np.stack([*good, noisy, noisy, noisy], axis=1).astype(np.int8)
    p, _, corr = toxicity.label_model(votes, 0.3)
    assert np.mean((p > 0.5) == y) > 0.93 and corr[3, 4] > 0.8


def test_mixing(spark):
    rows = [" ".join(["w"] * (k % 40)) for k in range(600)] + [None, "", "a", "a"]
    docs = table(spark, rows)
    got = mixing.mix(docs).collect()
    assert len(got) == 604 and all(r.taken <= 2 * r.size for r in got)
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
    sizes = {k: sum(r.size for r in v) for k, v in by.items()}
    order = [*sorted(k for k in by if k is not None), None]
    want, open_ = {}, {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}
    left = 1.5 * sum(sizes.values())
    while open_:  # deal by weight, cap, deal the excess again
        share = {k: left * w / sum(open_.values()) for k, w in open_.items()}
        over = [k for k in open_ if share[k] > 2 * sizes[k]]
        if not over:
            want |= share
            break
        for k in over:
            want[k] = 2 * sizes[k]
            left -= want[k]
            del open_[k]
    for k, v in by.items():
        assert v[0].source_size == sizes[k] and v[0].target == pytest.approx(want[k])
        assert abs(sum(r.taken for r in v) - want[k]) <= 0.02 * want[k] + 128
    key = lambda rs: sorted((r.doc_id, r.taken) for r in rs)
    assert key(got) == key(mixing.mix(docs.repartition(3)).collect())
    again = mixing.repeated(docs)
    assert again.columns == docs.columns
    words = again.select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert abs(words - sum(r.taken for r in got)) < 0.05 * words
    times = {r.doc_id: r["count"] for r in again.groupBy("doc_id").count().collect()}
    assert all(abs(times.get(r.doc_id, 0) * r.size - r.taken) <= r.size for r in got)
    halves = [r.source for r in again.collect()]  # in the schedule's order all sources come throughout
    assert set(halves[: len(halves) // 2]) == set(halves[len(halves) // 2 :])
    assert mixing.mix(empty(spark)).count() == 0


def brute_jaccard(rows):
    sets, comp = [], list(range(len(rows)))
    for t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = comp[i], comp[j]
                comp = [min(a, b) if x in (a, b) else x for x in comp]
    return {k: (len(s), c) for k, (s, c) in enumerate(zip(sets, comp, strict=True))}


def test_jaccard(spark):
    rng = np.random.default_rng(8)
    rows = texts()
    passage = " ".join(rng.choice(WORDS, 80))
    for k in range(60):  # texts that share a passage, more and less of it
        rows.append(passage + " " + " ".join(rng.choice(WORDS, 5 + k // 2)))
    vocabulary = [f"v{k}" for k in range(300)]
    seed = rng.choice(vocabulary, 70)
    for k in range(80):  # chains of near copies
        seed = seed.copy()
        seed[rng.integers(0, 70, 2)] = rng.choice(vocabulary, 2)
        rows.append(" ".join(seed))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(table(spark, rows)).collect()}
    assert got == brute_jaccard(rows)
    kept = jaccard.representatives(table(spark, rows))
    assert {r.doc_id for r in kept.collect()} == {k for k, (_, c) in got.items() if k == c}
    assert jaccard.near_duplicates(empty(spark)).count() == 0


def test_jaccard_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (0, "a b c d e f"), (None, None)], "doc_id long, text string")
    found = sorted((str(r.doc_id), str(r.component_id), r.n_shingles) for r in jaccard.near_duplicates(docs).collect())
    assert found == [("0", "0", 2), ("1", "0", 2), ("1", "0", 2), ("None", "0", 2), ("None", "None", 0)]
    assert sorted(str(r.doc_id) for r in jaccard.representatives(docs).collect()) == ["0", "None"]
    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (1, "q r s t u v", "y"), (2, "q r s t u v", "z"), (None, "k l m n o p", "w"), (None, "k l m n o p", "w")], "doc_id long, text string, `jaccard gone` string")
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text[0] for r in kept.collect()) == ["a", "k", "q"]


def test_jaccard_pairs(spark, monkeypatch):
    """All pairs, with small chunks and buckets, and shingles that many sets of a chunk hold."""
    rng = np.random.default_rng(4)
    monkeypatch.setattr(jaccard, "MANY", 3)
    monkeypatch.setattr(jaccard, "CHUNK", 500)
    monkeypatch.setattr(jaccard, "BUCKET", 100)
    seed, rows = rng.choice([f"v{k}" for k in range(300)], 60), texts()
    for _ in range(70):
        part = seed.copy()
        part[rng.integers(0, 60, 1)] = rng.choice(WORDS, 1)
        rows.append(" ".join(part[: rng.integers(45, 60)]))
    sets = {}
    for k, t in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        if w:
            sets.setdefault(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]), k)
    pairs = {(min(i, j), max(i, j), len(x & y)) for x, i in sets.items() for y, j in sets.items() if i < j and 100 * len(x & y) >= 75 * len(x | y)}
    got = jaccard.similar_pairs(table(spark, rows)).collect()
    assert {(min(r.left_id, r.right_id), max(r.left_id, r.right_id), r.both) for r in got} == pairs and len(got) == len(pairs) > 300
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(table(spark, rows)).collect()} == brute_jaccard(rows)


def test_language(spark):
    own = {"en": "the and ing tion of with", "de": "der die und ein ung nicht", "fr": "le la les que des ment", "es": "el los que ado ción para"}
    rng = np.random.default_rng(2)
    rows, langs = [], []
    for lang, words in own.items():
        for _ in range(60):
            rows.append(" ".join("".join(rng.choice(words.split(), 2)) for _ in range(20)))
            langs.append(lang)
    docs = spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(zip(rows, langs, strict=True))] + [(900, None, "en"), (901, "", "de"), (902, "12 !", None)], "doc_id long, text string, lang string")
    model = language.fit(docs.where("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in language.identified(docs, model).collect()}
    assert np.mean([got[k].lang_pred == langs[k] for k in range(1, 240, 2)]) > 0.97
    assert [got[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language.identified(docs, language.fit(docs.limit(0))).collect()} == {"und"}


def test_licenses(spark):
    rows = [None, "", "Licensed under the Apache License, Version 2.0.", "cc by CC-BY cc by-nc 4.0 all Rights reserved all rights reserved", "the GNU General Public License v3 or later", "İcc by K", "general public. license", "x " * 5000 + "cc by", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"]
    got = {r.doc_id: r for r in licenses.scan(table(spark, rows)).collect()}
    for k, t in enumerate(rows):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        assert got[k].n_words == len(words)
        for phrase, label in licenses.BASE:
            p = phrase.split()
            assert [s.start for s in got[k][label]] == [i for i in range(len(words)) if words[i : i + len(p)] == p], (k, label)
    assert [d.label for d in got[2].detections] == ["apache"] and got[2].detections[0].end == 8
    assert "cc-by-nc" in {d.label for d in got[3].detections} and {d.label for d in got[8].detections} == {"mit"}
    assert len(licenses.rules()) > 300 and max(len(r.pattern) for r in licenses.rules()) < 300


def test_license_rules_against_python(spark):
    """All rules by re over whole texts, with suppression by pairs."""
    rule_list = licenses.rules()
    rng = np.random.default_rng(4)
    names = [n for _, ns, _ in licenses.FAMILIES for n in ns]
    rows = [" ".join(rng.choice(["released", "under", "the", "license", "2 0", "version", "cc by", "all rights reserved", *rng.choice(names, 8)], 25)) for _ in range(30)]
    got = {r.doc_id: {(d.start, d.end, d.label) for d in r.detections} for r in licenses.scan(table(spark, rows)).collect()}
    for k, t in enumerate(rows):
        line = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())) + " "
        found = [(line[: m.start()].count(" ") - 1, line[: m.start()].count(" ") + m[0].count(" "), r.priority, r.label) for r in rule_list for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", line)]
        kept = {(a, b, x) for a, b, p, x in found if not any((c, d, q) != (a, b, p) and c <= a and b <= d and ((c, d) != (a, b) or q < p) for c, d, q, _ in found)}
        assert got[k] == kept, k


def spelt(pattern):
    """Texts that a rule's pattern matches: each branch, each option left out and taken, one sign of each class."""

    def parts(tree):
        texts = {""}
        for kind, value in tree:
            name = str(kind)
            if name == "LITERAL":
                new = {chr(value)}
            elif name == "IN":
                new = {chr(v if str(k) == "LITERAL" else v[0]) for k, v in value[:1]}
            elif name == "BRANCH":
                new = set().union(*(parts(b) for b in value[1]))
            elif name == "SUBPATTERN":
                new = parts(value[3])
            else:
                assert name == "MAX_REPEAT", name
                low, high, inner = value
                new = {t * n for t in parts(inner) for n in (low, min(int(high), low + 1))}
            texts = {a + b for a in texts for b in new}
        return texts

    return parts(re._parser.parse(pattern))


def test_license_keywords_stand_in_all_matches(spark):
    for r in licenses.rules():
        found = spelt(r.pattern)
        assert found and all(re.fullmatch(r.pattern, t) and f" {r.keyword}" in f" {t} " for t in found), r.name
    assert max(t.count(" ") + 3 for r in licenses.rules() for t in spelt(r.pattern)) < licenses.REACH
    long = licenses.scan(table(spark, ["SPDX-License-Identifier: " + "a" * 700, "cc by " * 3000 + "x " * 100_000 + "mit license"])).collect()
    assert {r.doc_id: {d.label for d in r.detections} for r in long} == {0: {"spdx"}, 1: {"cc-by", "mit"}}
    assert {r.doc_id: len(r["cc-by"]) for r in long} == {0: 0, 1: 3000}
    rows = ["an additional grant of patent rights", "a trademark of X", "a registered trademark of X", "trademarks are the property of their respective owners"]
    got = {r.doc_id: [d.label for d in r.detections] for r in licenses.scan(table(spark, rows)).collect()}
    assert got == {0: ["patent-grant"], 1: ["trademark"], 2: ["trademark"], 3: ["trademark"]}


def test_media_round_trip(spark):
    rng = np.random.default_rng(6)
    rows = [None, "", "a", "é👩" * 400, "x" * 575, "x" * 576, "x" * 577, "".join(map(chr, rng.integers(1, 0x250, 30000))), "same", "same"]
    got = {r.doc_id: r for r in media.media_digests(table(spark, rows)).collect()}
    for k, t in enumerate(rows):
        raw = (t or "").encode()
        want = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        r = got[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-32:]))
    assert got[8].feature == got[9].feature and got[8].media_sha256 == got[9].media_sha256
    files = media.stored_texts(table(spark, rows))
    shown = {r.id: r for r in media.tensors(files).collect()}
    assert all(len(r.rgb) == r.height * r.width * 3 for r in shown.values())
    bad = spark.createDataFrame([(1, None), (2, b"no image"), (3, b"\xff\xd8\xff\xd9")], "doc_id int, media binary")
    assert all(r.rgb is None for r in media.tensors(bad).collect())


def test_jpeg_without_restarts_and_all_coefficients():
    """Sequential decoding of one lane, runs of zeros, ends of bands, new coefficients in refinement."""
    rng = np.random.default_rng(9)
    for values in ([0, 0, 0, 1, -1, 2, -3], [0] * 40 + [1, -1, 5], [-128, 127, 0, 1]):
        coefs = rng.choice(values, (6 * 7, 64)).astype(np.int16)
        for step in (1, 8, 4 * 7):
            jpeg.RESTART, kept = step, jpeg.RESTART
            try:
                raw = jpeg.encode(coefs, [(1, 7)], [b""])[0]
            finally:
                jpeg.RESTART = kept
            img = jpeg.parse(raw)
            assert np.array_equal(jpeg.coefficients([img]), coefs)
    grey = jpeg.pixels(img, jpeg.samples([img], np.zeros((42, 64), np.int16)))
    assert grey.shape == (16, 112, 3) and (grey == 128).all()


def progressive(img, coefs, restart):
    """A file of an image's coefficients: first DC of all components, then AC of each in two bands, one sent in two steps."""
    values, lengths = jpeg._tables(jpeg.DC_SPEC, lambda size: size)
    parts = range(len(img.sampling))
    ids = bytes(x for p in parts for x in (p + 1, 0))
    frame = b"".join(bytes([p + 1, h << 4 | v, 0]) for p, (h, v) in enumerate(img.sampling))
    out = [b"\xff\xd8", jpeg._segment(0xDB, b"\0" + b"\1" * 64), jpeg._segment(0xC4, b"\0" + jpeg.DC_SPEC), jpeg._segment(0xC4, b"\x10" + jpeg.AC_SPEC), jpeg._segment(0xC2, struct.pack(">BHHB", 8, img.height, img.width, len(parts)) + frame), jpeg._segment(0xDD, struct.pack(">H", restart))]

    def scan(ids, band, entries, lanes):
        data, ends = jpeg._packed(*entries, lanes)
        cut = [0, *ends.tolist()]
        out.append(jpeg._segment(0xDA, bytes([len(ids) // 2]) + ids + bytes(band)))
        out.extend(data[cut[k] : cut[k + 1]].tobytes() + (bytes([0xFF, 0xD0 + k % 8]) if k < lanes - 1 else b"") for k in range(lanes))

    def alone(p):
        (rows, cols), wide = img.shown(p), img.grid(p)[1]
        return [img.base[p] // 64 + y * wide + x for y in range(rows) for x in range(cols)]

    order = [(k, 0, n) for n, k in enumerate(alone(0))]
    if len(parts) > 1:
        order = [(img.base[p] // 64 + (my * v + y) * img.grid(p)[1] + mx * h + x, p, my * img.mcus[1] + mx) for my in range(img.mcus[0]) for mx in range(img.mcus[1]) for p, (h, v) in enumerate(img.sampling) for y in range(v) for x in range(h)]
    lane = np.array([n // restart if restart else 0 for *_, n in order])
    diff, last = [], {}
    for (k, p, _), a in zip(order, lane.tolist(), strict=True):
        diff.append(int(coefs[k, 0]) - last.get((p, a), 0))
        last[p, a] = int(coefs[k, 0])
    scan(ids, (0, 0, 0), (values[np.array(diff) + 512], lengths[np.array(diff) + 512], lane), int(lane[-1]) + 1)
    for p in parts:
        v = coefs[alone(p)].astype(np.int32)
        lane = np.arange(len(v)) // (restart or len(v))
        one, lanes = bytes([p + 1, 0]), int(lane[-1]) + 1
        scan(one, (1, 5, 1), jpeg._encode_ac(v[:, 1:6], lane, 1), lanes)
        scan(one, (6, 63, 0), jpeg._encode_ac(v[:, 6:], lane, 0), lanes)
        scan(one, (1, 5, 1 << 4), jpeg._encode_refined(v[:, 1:6], lane), lanes)
    return b"".join(out) + b"\xff\xd9"


def test_tensors_of_odd_sizes_and_samplings(spark):
    """Images whose components' rows or columns aren't whole MCUs."""
    rng = np.random.default_rng(11)
    files, want = [], []
    for sampling in ([(2, 2), (1, 1), (1, 1)], [(2, 1), (1, 1), (1, 1)], [(1, 2), (1, 1), (1, 1)], [(1, 1)] * 3, [(2, 2)], [(3, 2), (2, 1), (1, 2)]):
        for height, width in ((52, 100), (1, 1), (9, 17), (16, 16), (33, 40)):
            for restart in (0, 5):
                img = jpeg.Image(height, width, sampling, [np.ones(64, np.int64)] * len(sampling), [])
                sizes = [rows * cols * 64 for rows, cols in map(img.grid, range(len(sampling)))]
                img.base = np.cumsum([0, *sizes[:-1]]).tolist()
                coefs = rng.choice([0, 0, 0, 0, 1, -1, 2, -3, 17], (sum(sizes) // 64, 64)).astype(np.int16)
                for p, (h, w) in enumerate(map(img.shown, range(len(sampling)))):  # blocks beyond the picture have no AC
                    blocks = coefs[img.base[p] // 64 :][: sizes[p] // 64].reshape(*img.grid(p), 64)
                    blocks[h:, :, 1:] = blocks[:, w:, 1:] = 0
                    if len(sampling) == 1:
                        blocks[h:] = blocks[:, w:] = 0
                files.append(progressive(img, coefs, restart))
                again = jpeg.parse(files[-1])
                assert np.array_equal(jpeg.coefficients([again]), coefs), (sampling, height, width, restart)
                want.append((height, width, jpeg.pixels(img, jpeg.samples([img], coefs)).tobytes()))
    assert all(len(rgb) == h * w * 3 for h, w, rgb in want)
    together = [jpeg.parse(f) for f in files[:4]]
    assert np.array_equal(jpeg.coefficients(together), np.concatenate([jpeg.coefficients([jpeg.parse(f)]) for f in files[:4]]))
    df = spark.createDataFrame(list(enumerate(files)), "doc_id int, media binary")
    got = {r.id: (r.height, r.width, bytes(r.rgb) if r.rgb is not None else None) for r in media.tensors(df).collect()}
    assert got == dict(enumerate(want))


def test_inverse_transform():
    block = np.zeros((1, 64), np.int16)
    block[0, 0], block[0, 1], block[0, 2] = 40, 25, -13
    img = jpeg.Image(8, 8, [(1, 1)], [np.ones(64, np.int64)], [])
    img.base = [0]
    want = np.zeros((8, 8))
    natural = {(0, 0): 40, (0, 1): 25, (1, 0): -13}
    for y in range(8):
        for x in range(8):
            want[y, x] = sum(c * (np.sqrt(0.125) if u == 0 else 0.5) * (np.sqrt(0.125) if v == 0 else 0.5) * np.cos((2 * y + 1) * u * np.pi / 16) * np.cos((2 * x + 1) * v * np.pi / 16) for (u, v), c in natural.items())
    assert np.abs(jpeg.pixels(img, jpeg.samples([img], block))[:, :, 0] - (want + 128)).max() <= 1


def test_bpe_as_tiktoken(spark):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = bpe.vocabulary()
    want = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rows = [None, "", "Hello  world!\n\n x", "it's 'S 'LL don't", "Ⅷ²½ ٣ 12345", "👩‍👩‍👧 é", "\x1f\x1e a\x85b ", "aᲊ՘ ֈ", "<|endoftext|>", "ab" * 20000, *texts()]
    enc = bpe.encode_texts(table(spark, rows), spans=True)
    got = {r.doc_id: r for r in enc.collect()}
    for k, t in enumerate(rows):
        assert got[k].ids == want.encode_ordinary(t or "")
        assert all(0 <= a < b <= len(t) for a, b in zip(got[k].starts, got[k].ends, strict=True))
    back = {r.doc_id: r.text for r in bpe.decode_ids(enc).collect()}
    assert all(back[k] == (t or "") for k, t in enumerate(rows))
    one = {r.doc_id: r for r in bpe.round_trip(table(spark, rows)).collect()}
    assert one[2].decoded_sha256 == hashlib.sha256(rows[2].encode()).hexdigest()
    assert one[2].ids_sha256 == hashlib.sha256(np.array(want.encode_ordinary(rows[2]), "<u4").tobytes()).hexdigest()
    assert bpe.ByteBpe(path, pattern).decode_text(np.array(want.encode_ordinary("👩")[:1], "<u4").tobytes()) == "�"
