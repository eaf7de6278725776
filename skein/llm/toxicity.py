"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model of their accuracies and
correlations, and a linear classifier that is trained on the model's posterior labels.

Voters see words, the first four and five bytes of words (patterns that inflected insults share) and pairs of words. Most
hold a hand-written lexicon or list of phrases; the others hold what labelled rows show to be telling, dealt into several
voters for each kind of pattern; voters for "clean" speak where a kind of pattern shows nothing. The label model is fitted
by expectation maximisation on the votes of labelled and of unlabelled texts alike, and never sees a label. Voters that
still agree when the label is known count less in it, by the correlation of their residuals. The classifier learns from the
posteriors of all these texts.

Contract for odd inputs: null and empty texts have no pattern and the score of the bias; texts are read whole; repeated
rows get equal scores; without labels every score is 0.5, with one label value near that value; an empty table gives no
rows; extra columns are never read, labels are looked up by doc_id only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, fold_of, lower_ascii, mix64, table, text_bytes, token_hashes, token_spans
from .linear import ftrl, labelled_sample, learned, sigmoid, sums_by_row
from .quality import scored

#: Rows of each label value, and unlabelled ones, that are learnt from, at most.
SAMPLE = 4000
#: Feature numbers: two bits for the kind (words, prefixes, pairs of words), the others a hash.
BITS, KINDS, PREFIXES, PAIRS = 20, 3, (4, 5), 3
PASSES, DEALT, SEEN = 4, 4, 3
#: Least log-odds, by the lower bound of its estimate and by itself, of what toxic and clean voters hold.
TELLING, HINTING, ERRORS = 1.0, 1.25, 3.0
#: Hand-written lexicons: each is a voter.
LEXICONS = (
    "stupid dumb foolish brainless witless mindless clueless dense dopey",
    "idiot moron imbecile cretin halfwit dimwit nitwit simpleton dunce",
    "idiots morons imbeciles cretins halfwits dimwits nitwits dunces fools",
    "clown buffoon joker fool laughingstock jester clowns buffoons",
    "loser losers failure failures nobody nobodies reject rejects washout",
    "pathetic pitiful laughable lame sad sorry feeble",
    "trash garbage rubbish junk dumpster landfill sewage",
    "scum scumbag lowlife vermin parasite parasites filth dregs",
    "worthless useless pointless hopeless valueless",
    "disgusting revolting repulsive sickening vile gross nauseating",
    "ugly hideous fugly grotesque deformed",
    "jerk creep weirdo freak psycho lunatic maniac",
    "bastard bastards prick pricks wanker tosser git",
    "bitch bitches slut whore skank",
    "shit shitty bullshit crap crappy crock",
    "fuck fucking fucked fucker motherfucker fck",
    "ass asshole arse arsehole dumbass jackass",
    "damn damned goddamn bloody hell",
    "hate hated despise loathe detest abhor",
    "kill murder strangle stab shoot hang slaughter",
    "die dead rot burn suffer drown",
    "coward cowards weakling wimp crybaby snowflake",
    "liar liars cheat cheater fraud crook crooks",
    "pig pigs swine rat rats snake dog dogs cockroach cockroaches",
    "dumm idiotisch arschloch scheisse scheiße dreck abschaum versager wichser trottel",
    "idiota estúpido imbécil mierda basura asqueroso cabrón tonto gilipollas",
    "idiote stupide imbécile merde ordure connard abruti débile salaud",
)
#: Phrases of two words: each row is a voter.
PHRASES = (
    ("shut up", "piss off", "get lost", "go away", "drop dead", "go die"),
    ("you idiot", "you moron", "you fool", "you loser", "you clown", "you scum"),
    ("are stupid", "are pathetic", "are worthless", "are disgusting", "are trash", "are garbage"),
    ("hate you", "kill you", "kill yourself", "hurt you", "destroy you", "hang yourself"),
    ("so dumb", "so stupid", "such trash", "total loser", "complete idiot", "utter garbage"),
    ("your kind", "you people", "those people", "nobody likes", "everyone hates", "deserve nothing"),
)


def _number(kind: int, hashes: np.ndarray) -> np.ndarray:
    return (kind << (BITS - 2)) | (hashes >> np.uint64(64 - BITS + 2)).astype(np.int64)


def _pairs(words: np.ndarray) -> np.ndarray:
    """Feature numbers of each word with the next one."""
    return _number(PAIRS, mix64(words[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + words[1:].astype(np.uint64)))


def patterns(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, feature numbers) of lower-case words, their prefixes and pairs of them."""
    buf, offs = text_bytes(column)
    for a, b in chunks(offs):
        part, at = lower_ascii(buf[offs[a] : offs[b]]), offs[a : b + 1] - offs[a]
        starts, ends, row = token_spans(part, at, signs=True)
        feats, owners = [_number(0, token_hashes(part, starts, ends))], [row]
        for kind, length in enumerate(PREFIXES, 1):
            long = ends - starts > length
            feats.append(_number(kind, mix64(token_hashes(part, starts[long], starts[long] + length))))
            owners.append(row[long])
        two = row[1:] == row[:-1]
        feats.append(_pairs(feats[0])[two])
        owners.append(row[1:][two])
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        yield a, np.searchsorted(owner[order], np.arange(b - a + 1)), np.concatenate(feats)[order]


def lexicon(words: list[str]) -> np.ndarray:
    buf, offs = text_bytes(pa.array(words))
    return _number(0, token_hashes(buf, offs[:-1], offs[1:]))


@dataclass(frozen=True)
class Voters:
    """A bit a voter for each feature. A toxic voter votes 1 on any of its features and else abstains; a clean one votes
    0 where none of its features is there."""

    toxic: np.ndarray
    clean: np.ndarray
    n_toxic: int
    n_clean: int

    def votes(self, features: list[np.ndarray]) -> np.ndarray:
        """-1 abstains."""
        out = np.full((len(features), self.n_toxic + self.n_clean), -1, np.int8)
        bits = np.arange(64, dtype=np.uint64)
        for i, f in enumerate(features):
            said, found = (((np.bitwise_or.reduce(x[f], initial=np.uint64(0)) >> bits) & np.uint64(1)).astype(bool) for x in (self.toxic, self.clean))
            out[i, : self.n_toxic][said[: self.n_toxic]] = 1
            out[i, self.n_toxic :][~found[: self.n_clean]] = 0
        return out


def _marked(sets: list[np.ndarray]) -> np.ndarray:
    """Bits of features: that of a voter is set where its row of `sets` is, or at the numbers that it holds."""
    out = np.zeros(1 << BITS, np.uint64)
    for k, x in enumerate(sets):
        out[x] |= np.uint64(1 << k)
    return out


def mined(features: list[np.ndarray], labels: np.ndarray) -> Voters:
    """Voters from the hand-written lists, and from the log-odds of the features' presence in labelled rows."""
    size = 1 << BITS
    seen = [np.bincount(np.concatenate([f for f, y in zip(features, labels, strict=True) if y == k] or [np.zeros(0, np.int64)]), minlength=size) for k in (0, 1)]
    n = [max(1, int((labels == k).sum())) for k in (0, 1)]
    odds = np.log((seen[1] + 0.1) / (n[1] + 0.2)) - np.log((seen[0] + 0.1) / (n[0] + 0.2))
    spread = np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5))
    kind, number = np.arange(size) >> (BITS - 2), np.arange(size)
    telling = (odds - ERRORS * spread > TELLING) & (seen[1] >= SEEN) & (kind < KINDS)
    toxic = [telling & (kind == k) & (number % DEALT == d) for k in range(KINDS) for d in range(DEALT)]
    toxic += [lexicon(words.split()) for words in LEXICONS]
    toxic += [np.concatenate([_pairs(lexicon(p.split())) for p in phrases]) for phrases in PHRASES]
    clean = [telling & (kind == k) for k in range(KINDS)]
    clean.append((odds > HINTING) & (seen[1] >= 2 * SEEN) & (kind < KINDS))
    return Voters(_marked(toxic), _marked(clean), len(toxic), len(clean))


def label_model(votes: np.ndarray, prior: float, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of label 1, chance of each vote given each label, correlation of voters' residuals)."""
    n, m = votes.shape
    hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(np.float64)
    said = hot[:, :, 2] - hot[:, :, 1]
    apart = said - said.mean(axis=0)
    size = np.sqrt((apart**2).sum(axis=0)) + 1e-9  # of voters that always say the same: no correlation
    raw = (apart.T @ apart) / np.outer(size, size)
    np.fill_diagonal(raw, 1.0)
    alike = 1 / np.maximum(1, (np.maximum(raw, 0) ** 8).sum(1))  # voters that say the same thing are one voter
    share = alike
    ones, zeros = (votes == 1).sum(1), (votes == 0).sum(1)
    p = np.where(ones > 0, 0.9, np.where(zeros > 0, 0.05, prior))
    chance, corr = np.zeros((2, m, 3)), np.eye(m)
    for k in range(rounds):
        for y, w in ((0, 1 - p), (1, p)):
            chance[y] = (np.einsum("i,ijv->jv", w, hot) + 0.1) / (w.sum() + 0.3)
        logs = np.einsum("ijv,yjv,j->yi", hot, np.log(chance), share)
        p = sigmoid(np.log(prior / (1 - prior)) + logs[1] - logs[0])
        if k % 10 == 9:
            means = np.stack([chance[y][:, 2] - chance[y][:, 1] for y in (0, 1)])
            rest = said - (p[:, None] * means[1] + (1 - p[:, None]) * means[0])
            norm = np.sqrt((rest**2).sum(0)) + 1e-9
            corr = (rest.T @ rest) / np.outer(norm, norm)
            share = np.minimum(alike, 1 / (1 + np.maximum(corr - np.eye(m), 0).sum(1)))
    return p, chance, corr


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        """A feature counts once in a text however often it is there."""
        out = np.zeros(len(column))
        for a, offs, f in patterns(column):
            rows = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
            used = self.weights[f] != 0
            both = np.unique((rows[used] << BITS) | f[used])
            at = np.searchsorted(both >> BITS, np.arange(len(offs)))
            out[a : a + len(offs) - 1] = sigmoid(self.bias + sums_by_row(self.weights[both & ((1 << BITS) - 1)], at))
        return out


def train(features: list[np.ndarray], y: np.ndarray) -> Model:
    """y: 1 or 0 of labelled rows, -1 of others."""
    size = 1 << BITS
    known = y[y >= 0] if len(y) else y
    if not len(known) or known.min() == known.max():
        return Model(np.zeros(size, np.float32), float(6 * known[0] - 3) if len(known) else 0.0)
    once: dict[bytes, int] = {}
    for k in np.argsort(-y, kind="stable").tolist():  # copies are no new evidence; a labelled one stays
        once.setdefault(np.unique(features[k]).tobytes(), k)
    features, y = [np.unique(features[k]) for k in once.values()], y[list(once.values())]
    labelled = np.flatnonzero(y >= 0)
    voters = mined([features[k] for k in labelled], y[labelled])
    posterior, _, _ = label_model(voters.votes(features), float(np.clip(y[labelled].mean(), 0.02, 0.98)))
    used = (voters.toxic | voters.clean) != 0  # other features only tell topics; a text without any is clean
    rows = [(np.append(f[used[f]], size), np.ones(int(used[f].sum()) + 1)) for f in features]
    w = ftrl(rows, posterior, size + 1, PASSES, np.ones(len(rows)), alpha=0.1, l1=1.0)
    return Model(w[:size].astype(np.float32), float(w[size]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = SAMPLE) -> Model:
    rows = labels.where(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    rows = rows.unionByName(docs.select("doc_id", F.lit(-1).alias("label")))
    return learned(labelled_sample(docs, rows, "label", most), patterns, train)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learnt = fold_of("doc_id", 4) != 2
    model = fit(docs.where(learnt), table(spark, sf_dir, "labels").where(learnt))
    return scored(docs, model, ["doc_id"], 4, 2)
