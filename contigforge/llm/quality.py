"""Quality classifier: overlapping heuristic labellers, accuracies by expectation maximisation, and a hashed linear scorer trained on the posterior.

Each labeller votes for a class (GOOD, JUNK, HARMFUL) or abstains. EM over the counts of all vote patterns in the corpus estimates how
each labeller votes given the class; a pattern's posterior then labels the documents that have it. The scorer is a logistic model of
hashed words, word shapes and the votes for HARMFUL, fitted to those soft labels on a sample of at most SAMPLE documents, those of least hash
of the id and text; of each class by the posterior it holds STRATUM documents, or all if there are fewer, and it is weighted back to the corpus.

Contract of vote(), fit() and score():
- a null text counts as empty; an empty text has no word, is JUNK by its votes, and is scored by the bias alone, then rejected;
- a null id stays null; repeated rows are scored each; an empty table gives no row, and fits a scorer that accepts every text with a word;
- other columns are ignored by the queries and come back unchanged in keep_good().
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import islice
from operator import eq
from sys import intern

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from .common import batch, checkpoint, documents, map_batches, texts, worker_state

ABSTAIN, GOOD, JUNK, HARMFUL = 0, 1, 2, 3
CLASSES = (GOOD, JUNK, HARMFUL)

# Common English words of abuse.
INSULTS = frozenset("idiot idiots moron morons stupid loser losers pathetic worthless disgusting clown clowns scum trash imbecile dumb retard bastard bitch asshole".split())

#: Documents that the scorer is fitted on, at most.
SAMPLE = 6000
#: Of these, documents of each class at least, as far as the corpus has them.
STRATUM = 1000
#: Hashed word features; shapes have a range of their own behind them, then come repeats and the bias. So wide that words which weigh share a number with few others.
WORDS, SHAPES = 1 << 26, 1 << 16
REPEATS, BIAS = WORDS + SHAPES, WORDS + SHAPES + 1
#: Features of the labellers that vote HARMFUL, one each; they weigh however few documents have them.
VOTES = BIAS + 1
#: A feature weighs nothing unless it is in so many documents of a full sample, in a smaller one in as great a share, but two at least; a word also unless their mean label is so many standard errors off the sample's.
MIN_DOCUMENTS = 25
MIN_ERRORS = 6
EM_ROUNDS = 60
#: A document is rejected above this probability of not being GOOD.
REJECT = 0.5

_RUN = re.compile(r"(.)\1+")
_SHAPE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))
_CORE = re.compile(r"\w+")


@dataclass
class View:
    """What the labellers look at; shares are of words or of characters."""

    words: int
    upper: float  # upper-case letters for each byte that is no white space
    bang: float  # words that hold an exclamation mark
    marks: float  # words in which one of *#$%&@~^ follows a letter, digit, full stop or comma
    odd: float  # ASCII characters that are neither letters, digits, white space nor usual punctuation
    bars: float  # words that are a bar
    same: float  # words equal to the word before
    distinct: float
    common: float  # share of the most frequent word
    stops: float  # words of up to three letters
    sentences: float  # sentence ends for each word
    insults: int


class Memo:
    """What a worker has met: the shape and feature of words, and the traits of shapes."""

    def __init__(self):
        self.word: dict[str, tuple[str, int]] = {}
        self.shape: dict[str, tuple[bool, bool, int]] = {}

    def clear(self) -> None:
        self.word.clear()
        self.shape.clear()

    def meet(self, word: str) -> tuple[str, int]:
        """shape and core of a word."""
        out = intern(shape(word)), core(word)  # words share few shapes
        if len(self.word) < 500_000:
            self.word[word] = out
        return out

    def traits(self, name: str) -> tuple[bool, bool, int]:
        """Of a shape: whether it has an exclamation mark, a mark as in View.marks, and the number of its feature."""
        if (out := self.shape.get(name)) is None:
            out = "!" in name, bool(_MARKED.search(name)), WORDS + zlib.crc32(name.encode()) % SHAPES
            if len(self.shape) < 200_000:
                self.shape[name] = out
        return out


_memo = Memo()


def shape(word: str) -> str:
    """Letters as A or a, digits as 0, runs folded."""
    return _RUN.sub(r"\1", word.encode().translate(_SHAPE).decode("latin-1"))


def core(word: str) -> int:
    """The number of a word's feature, from its first run of letters and digits in lower case; -1 without one, and -2 - number for an insult."""
    if not (found := _CORE.search(word)):
        return -1
    low = found.group().lower()
    out = zlib.crc32(low.encode()) % WORDS
    return -2 - out if low in INSULTS else out


def view(text: str) -> tuple[View, set[int], dict[str, int], int]:
    """The view of a text, the features of its words, how many words have each shape, and how many equal the word before."""
    words = text.split()
    n, counts, shapes, insults = len(words), Counter(words), {}, 0
    found = list(map(_memo.word.get, counts))
    if None in found:
        found = [f or _memo.meet(w) for f, w in zip(found, counts, strict=True)]
    names, cores = zip(*found, strict=True) if found else ((), ())
    for s, k in zip(names, counts.values(), strict=True):
        shapes[s] = shapes.get(s, 0) + k
    indices = set(cores)
    indices.discard(-1)
    if indices and min(indices) < 0:
        insults = sum(k for i, k in zip(cores, counts.values(), strict=True) if i < -1)
        indices = {i if i >= 0 else -i - 2 for i in indices}
    same = sum(map(eq, words, islice(words, 1, None)))
    raw = text.encode()
    inked = len(raw.translate(None, _SPACE))
    upper = len(raw) - len(raw.translate(None, _UPPER)) + (0 if text.isascii() else len(_UPPER_BEYOND.findall(text)))
    bang, marks = 0, 0
    for s, k in shapes.items():
        a, b, _ = _memo.traits(s)
        bang += k * a
        marks += k * b
    per = 1 / max(n, 1)
    return (
        View(
            n, upper / max(inked, 1), bang * per, marks * per, len(raw.translate(None, _USUAL)) / max(len(text), 1), counts.get("|", 0) * per, same * per, len(counts) * per,
            max(counts.values(), default=0) * per, sum(k for w, k in counts.items() if len(w) <= 3) * per, (text.count(". ") + text.count(".\n") + text.endswith(".")) * per, insults,
        ), indices, shapes, same,
    )


_SPACE = b" \t\n\r\x0b\x0c"
_UPPER = bytes(range(65, 91))
_UPPER_BEYOND = re.compile(r"[À-ÖØ-Þ]")
_MARKED = re.compile(r"[a-zA-Z0-9.,][*#$%&@~^]")
#: Bytes that are no odd mark: letters, digits, white space, usual punctuation and all beyond ASCII.
_USUAL = bytes(c for c in range(256) if c >= 128 or chr(c).isalnum() or chr(c) in " \t\n\r\x0b\x0c_.,;:'\"()?!-")

LABELLERS = {
    "shouting": lambda v: JUNK if v.upper > 0.5 else ABSTAIN,
    "exclaiming": lambda v: JUNK if v.bang > 0.15 else ABSTAIN,
    "marked": lambda v: JUNK if v.marks > 0.1 else ABSTAIN,
    "odd": lambda v: JUNK if v.odd > 0.06 else GOOD if v.odd < 0.01 else ABSTAIN,
    "barred": lambda v: JUNK if v.bars > 0.1 else ABSTAIN,
    "stammering": lambda v: JUNK if v.same > 0.2 else GOOD if v.same < 0.05 else ABSTAIN,
    "poor": lambda v: JUNK if v.words >= 20 and (v.common > 0.3 or v.distinct < 0.05) else ABSTAIN,
    "prose": lambda v: GOOD if v.upper < 0.3 and (0 < v.words < 60 and v.odd < 0.03 and v.same < 0.2 or v.stops > 0.15 and 0.004 < v.sentences < 0.5) else ABSTAIN,
    "unending": lambda v: JUNK if v.words > 40 and v.sentences < 0.004 else ABSTAIN,
    "empty": lambda v: JUNK if v.words == 0 else ABSTAIN,
    "insulting": lambda v: HARMFUL if v.insults else ABSTAIN,
    "abusive": lambda v: HARMFUL if v.insults >= 2 or v.words and v.insults / v.words > 0.002 else ABSTAIN,
    "civil": lambda v: ABSTAIN if v.insults else GOOD,
}
_HARM = [LABELLERS["insulting"], LABELLERS["abusive"]]


def shares(v: View, shapes: dict[str, int], same: int) -> dict[int, float]:
    """Features of a text beside its words: shares of shapes and of repeats, drawn towards 0 in short texts, and 1 for each vote for HARMFUL."""
    per, out = 8.0 / (max(v.words, 1) + 5), {}
    for s, k in shapes.items():
        i = _memo.traits(s)[2]
        out[i] = out.get(i, 0.0) + k * per
    out[REPEATS] = same * per
    return out | {VOTES + i: 1.0 for i, f in enumerate(_HARM) if f(v) == HARMFUL}


def features(v: View, indices: set[int], shapes: dict[str, int], same: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text: 1 for each of its words, and its shares."""
    beside = shares(v, shapes, same)
    return np.array([*sorted(indices), *beside], np.int32), np.array([1.0] * len(indices) + [*beside.values()], np.float32)


def pattern(v: View) -> int:
    """The labellers' votes as digits of base 4."""
    out = 0
    for f in LABELLERS.values():
        out = out * 4 + f(v)
    return out


def vote(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, pattern, pick): the votes on every text, and a hash that orders documents for sampling."""

    def make():
        worker_state("quality", lambda: _memo)

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            return batch(doc_id=(b.column("doc_id"), None), pattern=([pattern(view(t)[0]) for t in b.column("text").to_pylist()], pa.int64()), pick=(b.column("pick"), None))

        return one

    rows = texts(df, id_col, text_col)
    return map_batches(rows.withColumn("pick", F.xxhash64("doc_id", "text")), make, "doc_id long, pattern long, pick long")


def votes_of(patterns: np.ndarray) -> np.ndarray:
    """A row of votes for each pattern."""
    n = len(LABELLERS)
    return np.stack([patterns // 4 ** (n - 1 - i) % 4 for i in range(n)], 1).astype(np.int64) if len(patterns) else np.zeros((0, n), np.int64)


@dataclass
class VoteModel:
    """prior of each class, and share[labeller, class, vote] to abstain counts as a vote, as labellers of one kind of flaw are silent on the others."""

    prior: np.ndarray
    share: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = np.log(self.prior) + sum(np.log(self.share[i][:, votes[:, i]]).T for i in range(votes.shape[1]))
        p = np.exp(log - log.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def accuracy(self) -> np.ndarray:
        """Of each labeller: how often a vote of its is right."""
        joint = self.share[:, :, 1:] * self.prior[None, :, None]
        return np.einsum("lkk->l", joint) / joint.sum((1, 2))


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> VoteModel:
    """Begins from the plurality of votes, a vote against a document outweighing votes for it; weak priors keep every share above 0."""
    n, labellers, k = len(votes), votes.shape[1], len(CLASSES)
    post = np.full((n, k), 0.02)
    bad = (votes == JUNK).sum(1), (votes == HARMFUL).sum(1)
    post[np.arange(n), np.where(bad[1] > 0, 2, np.where(bad[0] > 0, 1, 0))] += 1
    post /= post.sum(1, keepdims=True) if n else 1
    hint = np.full((labellers, k, 4), 0.5)
    hint[:, np.arange(k), np.arange(1, 4)] += 1.0
    for _ in range(rounds):
        weight = post * counts[:, None]
        prior = (weight.sum(0) + 1) / (weight.sum() + k)
        share = hint + np.stack([np.stack([weight[votes[:, i] == v].sum(0) for v in range(4)], 1) for i in range(labellers)])
        model = VoteModel(prior, share / share.sum(2, keepdims=True))
        if n == 0:
            break
        post = model.posterior(votes)
    return model


def _train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, rounds: int = 300, decay: float = 1e-3, least: int | None = None, share: np.ndarray | None = None) -> dict[int, float]:
    """Logistic weights by Adagrad over all rows at once, decayed towards 0; both classes weigh alike. share: documents that each row stands for."""
    if not rows:
        return {}
    least = max(2, round(MIN_DOCUMENTS * len(rows) / SAMPLE)) if least is None else least
    sizes = np.array([len(i) for i, _ in rows])
    index, value = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]).astype(float)
    names, index, seen = np.unique(index, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(rows)), sizes)
    errors = (np.bincount(index, target[row]) / seen - target.mean()) / np.sqrt(max(target.var(), 1e-9) / seen)
    chosen = (seen >= least) & ((names >= WORDS) | (np.abs(errors) >= MIN_ERRORS)) | (names >= VOTES)
    used = chosen[index]
    row = row[used]
    index, value = index[used], value[used]
    w, bias = np.zeros(len(names)), 0.0
    power, bias_power = np.full(len(names), 1e-6), 1e-6
    share = np.ones(len(rows)) if share is None else share * (len(rows) / share.sum())
    bad = (target * share).sum()
    weight = share * np.where(target > 0.5, 0.5 / max(bad, 1), 0.5 / max(len(rows) - bad, 1))
    for _ in range(rounds):
        z = np.bincount(row, w[index] * value, len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * weight
        grad = np.bincount(index, error[row] * value, len(names)) + decay * w / len(rows)
        power += grad * grad
        bias_power += error.sum() ** 2
        w -= 0.3 * grad / np.sqrt(power)
        bias -= 0.3 * error.sum() / np.sqrt(bias_power)
    bias += np.log(max(bad, 0.5) / max(len(rows) - bad, 0.5))  # back from even classes to the sample's
    return {BIAS: float(bias)} | {int(k): float(x) for k, x, c in zip(names, w, chosen, strict=True) if c}


@dataclass
class Scorer:
    votes: VoteModel
    weights: dict[int, float]

    def logit(self, v: View, indices: set[int], shapes: dict[str, int], same: int) -> float:
        """The weighted sum of features(); few of a text's words weigh, and only these are looked at."""
        get = self.weights.get
        return get(BIAS, 0.0) + sum(get(i) for i in sorted(self.weights.keys() & indices)) + sum(get(i, 0.0) * x for i, x in shares(v, shapes, same).items())


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Scorer:
    """Estimates the labellers on all documents and fits the scorer on at most sample of them. To the driver come a count for each pattern of votes and the sample's features."""
    voted = vote(df, id_col, text_col)
    voted = checkpoint(voted)
    seen = voted.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").collect()
    patterns, counts = np.array([r.pattern for r in seen], np.int64), np.array([r.n for r in seen], float)
    model = expectation_maximisation(votes_of(patterns), counts)
    if not len(patterns):
        return Scorer(model, {})
    kind = model.posterior(votes_of(patterns)).argmax(1)
    there = np.bincount(kind, counts, len(CLASSES)).astype(int)
    floor = np.minimum(there, min(STRATUM, sample // len(CLASSES)))
    left = there - floor
    quota = floor + np.minimum(left, left * max(sample - floor.sum(), 0) // max(left.sum(), 1))
    picked = []
    for k, n in enumerate(quota.tolist()):
        if n:
            own = voted.filter(F.col("pattern").isin(patterns[kind == k].tolist()))
            picked += [r.pick for r in own.select("pick").orderBy("pick").limit(n).collect()]
    picked = df.sparkSession.createDataFrame([(p,) for p in sorted(set(picked))], "pick long")

    def make():
        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            index, value, codes = [], [], []
            for t in b.column("text").to_pylist():
                v, *found = view(t)
                i, x = features(v, *found)
                index.append(i.tobytes())
                value.append(x.tobytes())
                codes.append(pattern(v))
            return batch(pattern=(codes, pa.int64()), places=(index, pa.binary()), weights=(value, pa.binary()))

        return one

    chosen = texts(df, id_col, text_col).withColumn("pick", F.xxhash64("doc_id", "text")).join(F.broadcast(picked), "pick", "left_semi").dropDuplicates(["pick"])
    rows = map_batches(chosen.select("doc_id", "text"), make, "pattern long, places binary, weights binary").collect()  # at most sample rows, as picks are different
    post = model.posterior(votes_of(np.array([r.pattern for r in rows], np.int64)))
    got = post.argmax(1)
    share = there[got] / np.bincount(got, minlength=len(CLASSES))[got]
    return Scorer(model, _train([(np.frombuffer(r.places, np.int32), np.frombuffer(r.weights, np.float32)) for r in rows], 1 - post[:, 0], share=share))


SCORED = "doc_id long, text_hash long, n_words long, votes string, posterior double, score double, keep boolean"


def score(df: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """SCORED for every document. posterior: of not being GOOD by the votes; score: the same by the linear scorer, which decides keep."""
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(scorer)  # at most the sample's features that MIN_DOCUMENTS have, whatever the corpus

    def make():
        worker_state("quality", lambda: _memo)
        own = sent.value

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            n, z, codes = [], [], []
            for t in b.column("text").to_pylist():
                v, *found = view(t)
                n.append(v.words)
                z.append(own.logit(v, *found))
                codes.append(pattern(v))
            votes = votes_of(np.array(codes, np.int64))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            return batch(doc_id=(b.column("doc_id"), None), text_hash=(b.column("text_hash"), None), n_words=(n, pa.int64()), votes=(["".join("-gjh"[x] for x in row) for row in votes], pa.string()), posterior=(1 - own.votes.posterior(votes)[:, 0], pa.float64()), score=(p, pa.float64()), keep=((p <= reject) & (np.array(n) > 0), pa.bool_()))

        return one

    return map_batches(texts(df, id_col, text_col).withColumn("text_hash", F.xxhash64("text")), make, SCORED)


def keep_good(df: DataFrame, scorer: Scorer, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The rows of df whose text is kept, all columns as they were: rows are scored and dropped where they are read."""
    ship(df.sparkSession)
    sent, at = df.sparkSession.sparkContext.broadcast(scorer), df.columns.index(text_col)

    def run(batches):
        worker_state("quality", lambda: _memo)
        own = sent.value
        for b in batches:
            good = []
            for t in b.column(at).to_pylist():
                v, *found = view(t or "")
                good.append(v.words > 0 and own.logit(v, *found) <= limit)
            yield b.filter(pa.array(good, pa.bool_()))

    limit = float(np.log(reject / (1 - reject)))
    return df.mapInArrow(run, df.schema)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes, posterior, score and verdict for every document."""
    docs = documents(spark, sf_dir)
    return score(docs, fit(docs)).drop("text_hash")
