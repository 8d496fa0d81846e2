"""Toxicity by weak supervision.

1. Lexicons. From a bounded sample of labelled rows, the word stems that go
   with the label are found by a likelihood-ratio test that allows for the
   number of stems tried. They are dealt over several lexicon voters; a fixed
   seed lexicon and text patterns (shouting, exclamations, symbols, address,
   repetition) are further voters.
2. Votes. One scan over all whole texts writes a narrow row per document: its
   votes as bits and the lexicon stems that it holds.
3. Label model. The votes of all documents are counted by pattern (a bounded
   table: one row per combination) and a generative model is fitted to the
   counts by expectation maximisation: the class share and each voter's rates
   given the class. Labels of learning rows, where present, help to estimate
   these rates. Voters that stay correlated given the class are joined into
   blocks with a joint table of their own, and the model is fitted again.
4. Classifier. Logistic regression on stems and patterns, trained on the label
   model's posteriors, given the voters' votes alone, of a bounded sample of all
   learning rows, scores every row.
5. Calibration. A slope and an offset of the classifier's logits are fitted to
   the labels of the bounded sample of step 1, so that 0.5 is even odds.

Learning rows are those whose crc32(doc_id as text) mod 5 is not 0. The label,
language, source and id never enter a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwright.llm.common import materialise

#: Bounds of the two samples: labelled rows for lexicons, rows for the classifier.
SAMPLE = 20_000
#: Most stems in the lexicons.
STEMS = 2_000
LEXICONS = 6

# Seed lexicon of common English insults.
SEED_LEXICON = frozenset("""
idiot moron stupid scum trash loser pathetic worthless disgusting clown dumb fool jerk vermin
bastard imbecile filth retard creep
""".split())

_WORD = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"\b[^\W\d_a-z]{4,}\b")
_ADDRESS = re.compile(r"\b(?:you|your|du|dich|tu|toi|vous|tú|eres)\b")
PATTERNS = ("shouting", "exclaiming", "symbols", "address", "repetition")
VOTERS = 1 + LEXICONS + len(PATTERNS)


def stems(word: str) -> list[str]:
    """The word's prefixes of 4, 5 and 6 letters, and the word if shorter than 7."""
    n = len(word)
    return [word[:k] for k in (4, 5, 6) if n > k] + ([word] if 3 <= n <= 6 else [])


#: A stem shared by so many distinct words of a text is also a mark of its own.
TIERS = (2, 4)


def stem_marks(words: set[str], known: frozenset[str] | None = None) -> list[str]:
    """The stems of a text's distinct words, and ``stem+k`` for each stem that
    ``k`` of them share. With ``known`` only marks of stems in it."""
    count = Counter(s for w in words for s in stems(w) if known is None or s in known)
    return [*count, *(f"{s}+{k}" for s, n in count.items() if n > 1 for k in TIERS if n >= k)]


def is_learning(doc_id: Column) -> Column:
    """False for held-out rows; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def _sample_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document a mark that near copies share, its label and its stems."""
    for b in batches:
        marks, labels, found = [], [], []
        for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            words = _WORD.findall((t or "").lower())
            grams = zip(words, words[1:], words[2:])
            marks.append(min((xxhash.xxh64_intdigest(" ".join(g)) for g in grams),
                             default=0) >> 1)
            labels.append(y)
            found.append(stem_marks(set(words)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(marks, pa.int64()), pa.array(labels, pa.int32()),
             pa.array(found, pa.list_(pa.string()))], names=["mark", "toxic", "stems"])


def learn_lexicon(sample: DataFrame, most: int = STEMS) -> list[str]:
    """Stems that go with ``toxic`` in ``sample`` (text, toxic), best first.

    Near copies of one text with one label count once. A stem must be in twice
    as many toxic as other texts, and its likelihood ratio must exceed what the best
    of as many random stems would reach.
    """
    one = sample.mapInArrow(_sample_stems, "mark long, toxic int, stems array<string>")
    one = materialise(one.dropDuplicates(["mark", "toxic"]), "toxicity-sample")
    totals = {r.toxic: r.n for r in one.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad:
        return []
    counts = (one.select("toxic", F.explode("stems").alias("stem")).groupBy("stem")
              .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")))
    counts = materialise(counts, "toxicity-stems")
    tried = counts.count()
    share = bad / (bad + good)
    n = F.col("a") + F.col("b")
    part = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    ratio = 2 * (part(F.col("a"), share) + part(F.col("b"), max(1 - share, 1e-9)))
    chosen = (counts.withColumn("ratio", ratio)
              .filter((F.col("ratio") > 2 * math.log(tried + 1) + 4)
                      & (F.col("a") >= 2 * F.col("b")) & (F.col("a") > share * n))
              .orderBy(F.col("ratio").desc(), "stem").limit(most))
    return [r.stem for r in chosen.select("stem").collect()]


def votes_of(text: str, index: dict[str, int], known: frozenset[str]) -> tuple[int, list[int]]:
    """(vote bits, lexicon stems held) of a text; nothing for an empty one."""
    low = text.lower()
    words = _WORD.findall(low)
    if not words:
        return 0, []
    n, distinct = len(words), set(words)
    hits = sorted(index[m] for m in stem_marks(distinct, known) if m in index)
    bits = int(not SEED_LEXICON.isdisjoint(distinct))
    for h in hits:
        bits |= 2 << h % LEXICONS
    patterns = (len(_SHOUT.findall(text)) > 0.2 * n, text.count("!") > 0.05 * n,
                sum(text.count(c) for c in "#*$%&@") > 0.1 * n,
                len(_ADDRESS.findall(low)) > 0.02 * n, n > 20 and len(distinct) < 0.2 * n)
    for k, hit in enumerate(patterns):
        bits |= int(hit) << 1 + LEXICONS + k
    return bits, hits


def _votes(lexicon: list[str]):
    index = {m: k for k, m in enumerate(lexicon)}
    known = frozenset(m.partition("+")[0] for m in lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [votes_of(t, index, known) if t else (0, []) for t in
                     (x.as_py() for x in b.column("text"))]
            rest = [b.column(n) for n in b.schema.names if n != "text"]
            names = [n for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array([v for v, _ in found], pa.int32()),
                 pa.array([h for _, h in found], pa.list_(pa.int32()))],
                names=[*names, "votes", "hits"])
    return run


class LabelModel:
    """Two-class model of voters' rates given the class, with joint tables for
    blocks of voters that are correlated given the class.

    Fitted to counts of (vote bits, gold label or -1). ``rates`` are P(vote |
    class) per voter, ``correlations`` the pairwise ones given the class.
    """

    def __init__(self, patterns: np.ndarray, gold: np.ndarray, counts: np.ndarray,
                 n_voters: int = VOTERS, max_block: int = 8, joined_above: float = 0.3,
                 rounds: int = 200):
        self.n = n_voters
        self.blocks = [[k] for k in range(n_voters)]
        votes = (patterns[:, None] >> np.arange(n_voters)) & 1
        weight = counts / max(counts.sum(), 1)
        known = weight[gold >= 0].sum()
        self.prior = 0.1 if known == 0 else float(
            np.clip(weight[gold == 1].sum() / known, 0.001, 0.5))
        start = self._start(votes, gold)
        post = self._fit(patterns, gold, weight, start, rounds)
        self.correlations = self._correlations(patterns, votes, gold, weight)
        self.blocks = self._join(max_block, joined_above)
        if len(self.blocks) < n_voters:
            # From the start again, a block counting once: the first fit may have
            # taken what correlated voters agree on for the class.
            post = self._fit(patterns, gold, weight, self._start(votes, gold), rounds)
        self.rates = np.array([(weight * p) @ votes / max((weight * p).sum(), 1e-12)
                               for p in (1 - post, post)])

    def _start(self, votes, gold):
        """First posteriors: each block of lexicon voters speaks for the class if
        any of it votes, gold labels are near certain."""
        score = np.full(len(votes), math.log(self.prior / (1 - self.prior)))
        for b in self.blocks:
            lexical = [k for k in b if k < 1 + LEXICONS]
            if lexical:
                score += np.where(votes[:, lexical].any(axis=1), math.log(10), math.log(0.9))
        start = 1 / (1 + np.exp(-score))
        return np.where(gold >= 0, np.where(gold == 1, 0.95, 0.05), start)

    def _correlations(self, patterns, votes, gold, weight):
        """Pairwise correlations given the class, which is judged by the other
        voters: a pair's own votes would pass their agreement off as the class."""
        own = [np.log(t[1][self._code(patterns, b)] / t[0][self._code(patterns, b)])
               for b, t in zip(self.blocks, self.tables)]
        total = self._score(patterns, gold)
        out = np.eye(self.n)
        for i in range(self.n):
            for j in range(i):
                post = 1 / (1 + np.exp(-np.clip(total - own[i] - own[j], -30, 30)))
                for p in (1 - post, post):
                    w = weight * p
                    mass = max(w.sum(), 1e-12)
                    x, y = (votes[:, k] - (w @ votes[:, k]) / mass for k in (i, j))
                    spread = math.sqrt(max((w @ x ** 2) * (w @ y ** 2), 1e-18))
                    out[i, j] += mass * (w @ (x * y)) / spread
                out[i, j] /= max(weight.sum(), 1e-12)
                out[j, i] = out[i, j]
        return out

    def _join(self, max_block, above):
        block = {k: [k] for k in range(self.n)}
        order = sorted(((abs(self.correlations[i, j]), i, j) for i in range(self.n)
                        for j in range(i)), reverse=True)
        for c, i, j in order:
            a, b = block[i], block[j]
            if c > above and a is not b and len(a) + len(b) <= max_block:
                both = sorted(a + b)
                for k in both:
                    block[k] = both
        return [list(b) for b in dict.fromkeys(tuple(b) for b in block.values())]

    def _code(self, patterns, b):
        return sum(((patterns >> k) & 1) << at for at, k in enumerate(b))

    def _fit(self, patterns, gold, weight, post, rounds):
        codes = [self._code(patterns, b) for b in self.blocks]
        for _ in range(rounds):
            self.tables = []
            for b, code in zip(self.blocks, codes):
                t = np.array([np.bincount(code, weight * p, 1 << len(b)) for p in (1 - post, post)],
                             float)
                t += 1e-4 * t.sum(axis=1, keepdims=True) / (1 << len(b)) + 1e-9
                self.tables.append(t / t.sum(axis=1, keepdims=True))
            self.gold = np.array([[max((weight * p)[gold == y].sum(), 1e-9) for y in (0, 1)]
                                  for p in (1 - post, post)])
            self.gold /= self.gold.sum(axis=1, keepdims=True)
            self.prior = float(np.clip((weight * post).sum() / max(weight.sum(), 1e-12), 1e-4, 0.6))
            new = self.posterior(patterns, gold)
            done = np.abs(new - post).max(initial=0) < 1e-7
            post = new
            if done:
                break
        return post

    def _score(self, patterns: np.ndarray, gold: np.ndarray) -> np.ndarray:
        score = np.full(len(patterns), math.log(self.prior / (1 - self.prior)))
        for b, t in zip(self.blocks, self.tables):
            code = self._code(patterns, b)
            score += np.log(t[1][code] / t[0][code])
        seen = gold >= 0
        score[seen] += np.log(self.gold[1][gold[seen]] / self.gold[0][gold[seen]])
        return score

    def posterior(self, patterns: np.ndarray, gold: np.ndarray) -> np.ndarray:
        """P(toxic | votes, gold label if it is 0 or 1)."""
        return 1 / (1 + np.exp(-np.clip(self._score(patterns, gold), -30, 30)))


def features(votes: np.ndarray, hits: list[np.ndarray], n_stems: int):
    """(row, column) of the features that are 1, and the column count: stems,
    voters, and steps of how many stems a text holds."""
    row = [np.repeat(np.arange(len(votes)), [len(h) for h in hits])]
    column = [np.concatenate(hits).astype(np.int64) if len(hits) else np.empty(0, np.int64)]
    for k in range(VOTERS):
        r = np.flatnonzero(votes >> k & 1)
        row.append(r)
        column.append(np.full(len(r), n_stems + k))
    many = np.array([len(h) for h in hits], np.int64)
    for k, least in enumerate((1, 2, 4, 8)):
        r = np.flatnonzero(many >= least)
        row.append(r)
        column.append(np.full(len(r), n_stems + VOTERS + k))
    return np.concatenate(row), np.concatenate(column), n_stems + VOTERS + 4


def train_linear(row, column, n_columns: int, target: np.ndarray, ridge: float = 3e-4,
                 rounds: int = 800) -> np.ndarray:
    """Logistic regression weights (the last is the intercept) for soft
    targets, by accelerated gradient steps. Deterministic."""
    n = max(len(target), 1)
    most = np.bincount(row, minlength=n).max(initial=0) + 1
    step = 4.0 / most
    w = np.zeros(n_columns + 1)
    share = float(np.clip(target.mean() if len(target) else 0.01, 1e-3, 0.5))
    w[-1] = math.log(share / (1 - share))
    ahead, last = w.copy(), w
    for k in range(rounds):
        z = ahead[-1] + np.bincount(row, ahead[column], n)
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target if len(target) else np.zeros(n)
        slope = np.bincount(column, error[row], n_columns) / n + ridge * ahead[:-1]
        w = ahead - step * np.r_[slope, error.mean()]
        ahead = w + k / (k + 3) * (w - last)
        last = w
    return w


def calibrate(logits: np.ndarray, labels: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Slope and offset of ``logits`` for which ``labels`` (0, 1) are likeliest.

    The targets are drawn in by one row of either class, so that separable
    labels have finite ones too. (1, 0) if a class has no row or the slope
    would not be positive.
    """
    bad, good = int((labels == 1).sum()), int((labels == 0).sum())
    if not bad or not good:
        return np.array([1.0, 0.0])
    target = np.where(labels == 1, (bad + 1) / (bad + 2), 1 / (good + 2))
    x, w = np.c_[logits, np.ones(len(logits))], np.array([1.0, 0.0])

    def loss(w):
        return np.logaddexp(0, x @ w).sum() - target @ (x @ w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (p - target))
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w if w[0] > 0 else np.array([1.0, 0.0])


def _scores(weights: np.ndarray, n_stems: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            votes = b.column("votes").to_numpy()
            hits = [np.array(h, np.int64) for h in b.column("hits").to_pylist()]
            row, column, _ = features(votes, hits, n_stems)
            z = weights[-1] + np.bincount(row, weights[column], len(votes))
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            names = [n for n in b.schema.names if n not in ("votes", "hits")]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in names], pa.array(score)], names=[*names, "score"])
    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, text_hash, held_out, score, predicted.

    ``labels`` has doc_id and toxic (0, 1; null is no label; of several labels
    of one document the largest counts). ``sample`` bounds the rows from which
    lexicons, classifier and calibration are learnt. Null and empty texts hold no words and
    get the score of a text without any feature; texts of any length are read
    whole. Without labels the seed lexicon and the patterns vote alone and
    nothing is calibrated. Repeated rows get equal scores, equal stems rank by
    their letters, an empty table gives no rows. Other columns are not read.
    """
    spark, id_type = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    learning = (labels.filter(F.col("toxic").isin(0, 1) & is_learning(F.col("doc_id")))
                .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    learning = materialise(learning, "toxicity-labels")
    by_hash = [F.xxhash64(F.lit("sample"), "doc_id"), "doc_id"]
    chosen = materialise(learning.orderBy(*by_hash).limit(sample), "toxicity-chosen")
    # At most ``sample`` narrow rows, so the broadcast is bounded.
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    lexicon = learn_lexicon(labelled.select("text", "toxic"))
    voted = materialise(
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
        .mapInArrow(_votes(lexicon), f"doc_id {id_type}, text_hash long, votes int, hits array<int>"),
        "toxicity-votes")
    with_gold = voted.join(learning, "doc_id", "left").withColumn(
        "gold", F.coalesce("toxic", F.lit(-1)))
    # One row per combination of votes and label: at most 3 * 2^VOTERS.
    table = with_gold.groupBy("votes", "gold").count().orderBy("votes", "gold").collect()
    patterns = np.array([r.votes for r in table], np.int64)
    gold = np.array([r.gold for r in table], np.int64)
    model = LabelModel(patterns, gold, np.array([r["count"] for r in table], float))
    # Narrow rows of a thinned table, at most ``sample`` of each kind.
    share = min(1.0, 2 * sample / max(1, sum(r["count"] for r in table)))
    thin = F.pmod(F.xxhash64(F.lit("thin"), "doc_id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))
    learnt = voted.filter(is_learning(F.col("doc_id")) & thin)
    known = with_gold.filter("gold >= 0").join(F.broadcast(chosen.select("doc_id")), "doc_id")

    def taken(rows: DataFrame, *more: str):
        got = rows.orderBy(*by_hash, "text_hash").limit(sample).select("votes", "hits", *more).collect()
        votes = np.array([r.votes for r in got], np.int64)
        return got, votes, features(votes, [np.array(r.hits, np.int64) for r in got], len(lexicon))
    _, votes, (row, column, n) = taken(learnt)
    weights = train_linear(row, column, n, model.posterior(votes, np.full(len(votes), -1)))
    got, votes, (row, column, _) = taken(known, "gold")
    logits = weights[-1] + np.bincount(row, weights[column], len(votes))
    slope, offset = calibrate(logits, np.array([r.gold for r in got], np.int64))
    weights = slope * weights
    weights[-1] += offset
    scored = voted.mapInArrow(_scores(weights, len(lexicon)),
                              f"doc_id {id_type}, text_hash long, score double")
    return scored.select("doc_id", "text_hash", (~is_learning(F.col("doc_id"))).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the documents predicted toxic; all columns are kept."""
    bad = materialise(
        toxicity_scores(docs, labels, sample).filter("predicted = 1")
        .select(F.col("doc_id").alias("_bid"), F.col("text_hash").alias("_bhash")).distinct(),
        "toxic-documents")
    names = docs.columns
    keyed = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)],
                        F.xxhash64("text").alias("_hash"), F.col("doc_id").alias("_id"))
    # The narrow side is hashed, so texts aren't sorted for the join.
    left = keyed.join(bad.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_bid"))
                      & (F.col("_hash") == F.col("_bhash")), "left_anti")
    return left.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
