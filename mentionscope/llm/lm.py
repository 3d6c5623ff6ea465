"""Language-model scores of whole documents.

The model is log-bilinear over the last two words: the context vector is
R1[u] + R2[v], a word's logit is its vector's product with it plus a bias. The
output classes are the most frequent words, the end, and one class of all other
words, within which a word has its smoothed unigram probability, so every
token has a normalised probability. Classes are trained by noise-contrastive
estimation in numpy, each task over its own documents, the parameters averaged
between rounds; scoring takes the log-softmax of each distinct context of a
batch by one matrix product.

Counts are exact and cover all training documents. Frequent words (by a
heavy-hitter pass over all tasks) are counted by adding up fixed-size arrays;
all other words are dealt out once as (word, document, times), which gives
their counts and the documents' sums in the same place, so no hot word is shuffled.

Bounds: ``HOT`` words are broadcast, ``CLASSES`` of them are model classes.

Edge cases: null or empty text is the end token alone; a null doc_id is read as
the empty text by the fold; repeated rows get equal scores and each counts in
training; without training documents every token is unknown; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_slices, cut, lower_words, stored

HOT = 1 << 16
CLASSES = 510          # frequent words that are output classes
WIDTH, NOISE, BATCH, RATE, ROUNDS = 16, 48, 2048, 0.05, 2
END, REST, SIZE = CLASSES, CLASSES + 1, CLASSES + 2
SMOOTH = 0.1


def fold(doc_id) -> "F.Column":
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10


def heavy_words(train: DataFrame, hot: int = HOT) -> np.ndarray:
    """Hashes of about the ``hot`` most frequent training words: every task names
    its most frequent ones over all of its documents. The choice only decides how a word is counted."""
    def run(batches):
        held_w, held_n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for _, texts in arrow_slices(batches, limit=8 << 20):
            w, n = np.unique(lower_words(texts)[1], return_counts=True)
            held_w, at = np.unique(np.concatenate([held_w, w]), return_inverse=True)
            held_n = np.bincount(at, np.concatenate([held_n, n]), len(held_w)).astype(np.int64)
            if len(held_w) > 8 * hot:  # rare so far; their counts are made exactly later
                top = np.argpartition(-held_n, 4 * hot)[: 4 * hot]
                top.sort()
                held_w, held_n = held_w[top], held_n[top]
        top = np.argsort(-held_n, kind="stable")[:hot]
        yield pa.RecordBatch.from_arrays([pa.array(held_w[top].view(np.int64)), pa.array(held_n[top])], ["w", "n"])

    rows = train.select("text").mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(hot)
    return np.array([r["w"] for r in rows.collect()], np.int64).view(np.uint64)


def _summed(parts: DataFrame, blocks: int) -> dict[int, np.ndarray]:
    """Adds up fixed-size arrays of doubles, sent in blocks, on the executors; ``blocks`` rows are collected."""
    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[b] = total.get(b, 0) + np.frombuffer(x)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["b", "x"])

    out: dict[int, np.ndarray] = {}
    for r in parts.repartition(max(1, min(blocks, 16)), "b").mapInArrow(add, "b int, x binary").collect():
        out[r["b"]] = out.get(r["b"], 0) + np.frombuffer(r["x"])
    return out


def _in_blocks(x: np.ndarray, size: int = 8192) -> pa.RecordBatch:
    cuts = [x[i: i + size].astype(np.float64).tobytes() for i in range(0, len(x), size)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(cuts)), pa.int32()), pa.array(cuts, pa.binary())], ["b", "x"])


def _joined(blocks: dict[int, np.ndarray], size: int) -> np.ndarray:
    return np.concatenate([blocks[b] for b in sorted(blocks)]) if blocks else np.zeros(size)


class Vocabulary:
    """Frequent words in order of their hashes, with their exact training counts."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes)
        self.counts = np.zeros(len(hashes), np.int64)
        self.classes = np.full(len(hashes), REST)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.hashes, self.counts, self.classes

    @classmethod
    def of(cls, hashes, counts, classes) -> "Vocabulary":
        out = cls(hashes)
        out.counts, out.classes = counts, classes
        return out

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each word, -1 where it is not a frequent one."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)

    def rank(self, counts: np.ndarray) -> None:
        self.counts = counts
        top = np.lexsort((self.hashes, -counts))[:CLASSES]
        top = top[counts[top] > 0]
        self.classes = np.full(len(counts), REST)
        self.classes[top] = np.arange(len(top))
        self.model_words = len(top)


def tokens(texts: list[bytes], vocabulary: Vocabulary):
    """(place in the vocabulary, hash, text index) of each word, then class and text
    index of each token, ends included."""
    doc, h = lower_words(texts)
    at = vocabulary.find(h)
    classes = np.where(at >= 0, vocabulary.classes[at] if len(vocabulary.classes) else REST, REST)
    counts = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), int)
    ends = np.cumsum(counts)
    return at, h, doc, np.insert(classes, ends, END), np.repeat(np.arange(len(texts)), counts + 1)


def contexts(c: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two classes before each token, END before a text."""
    v = np.concatenate([[END], c[:-1]])
    u = np.concatenate([[END, END], c[:-2]])[: len(c)]
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    second = np.concatenate([[False], first[:-1]])
    return np.where(first | second, END, u), np.where(first, END, v)


class Model:
    """Parameters in one array: R1, R2, Q (SIZE x WIDTH each) and the biases."""

    def __init__(self, flat: np.ndarray) -> None:
        self.flat = flat
        part = SIZE * WIDTH
        self.r1, self.r2, self.q = (flat[k * part: (k + 1) * part].reshape(SIZE, WIDTH) for k in range(3))
        self.b = flat[3 * part:]
        self.past = np.zeros(len(flat))

    @classmethod
    def start(cls, unigram: np.ndarray, seed: int = 7) -> "Model":
        rng = np.random.default_rng(seed)
        flat = np.concatenate([rng.normal(0, 0.1, 3 * SIZE * WIDTH), np.log(unigram)])
        return cls(flat)

    def step(self, u, v, w, noise, log_noise, rate: float) -> None:
        """One noise-contrastive step: data words against noise words shared by the batch."""
        h = self.r1[u] + self.r2[v]
        k = len(noise)
        score = (h * self.q[w]).sum(1) + self.b[w] - log_noise[w] - np.log(k)
        data = 1 / (1 + np.exp(np.clip(score, -30, 30)))                # 1 - P(data)
        other = h @ self.q[noise].T + self.b[noise] - log_noise[noise] - np.log(k)
        false = -1 / (1 + np.exp(-np.clip(other, -30, 30)))             # -P(data)
        dh = data[:, None] * self.q[w] + false @ self.q[noise]
        grad = Model(np.zeros_like(self.flat))
        np.add.at(grad.q, noise, false.T @ h)
        np.add.at(grad.b, noise, false.sum(0))
        _scatter(grad.q, w, data[:, None] * h)
        np.add.at(grad.b, w, data)
        _scatter(grad.r1, u, dh)
        _scatter(grad.r2, v, dh)
        grad.flat /= len(w)
        self.past += grad.flat ** 2  # Adagrad: each parameter's own step size
        self.flat += rate * grad.flat / np.sqrt(self.past + 1e-10)

    def log_probabilities(self, u, v, w) -> np.ndarray:
        """Normalised log10 probabilities: one matrix product per block of distinct contexts."""
        met = u * SIZE + v
        seen = np.zeros(SIZE * SIZE, bool)
        seen[met] = True
        code = np.flatnonzero(seen)
        place = np.empty(SIZE * SIZE, np.int32)
        place[code] = np.arange(len(code))
        z = np.empty(len(code))
        for first in range(0, len(code), 2048):
            c = code[first: first + 2048]
            s = (self.r1[c // SIZE] + self.r2[c % SIZE]).astype(np.float32) @ self.q.T.astype(np.float32) + self.b.astype(np.float32)
            top = s.max(1)
            z[first: first + 2048] = top + np.log(np.exp(s - top[:, None]).sum(1, dtype=np.float64))
        return (((self.r1[u] + self.r2[v]) * self.q[w]).sum(1) + self.b[w] - z[place[met]]) / np.log(10)


def _scatter(target: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(rows.astype(np.int16), kind="stable")     # classes fit 16 bits, which numpy sorts by radix
    r = rows[order]
    first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
    target[r[first]] += np.add.reduceat(values[order], first)


def vocabulary_of(train: DataFrame, hot: int = HOT) -> tuple[Vocabulary, int, int]:
    """The frequent words with exact counts, the number of training words and documents."""
    vocabulary = Vocabulary(heavy_words(train, hot))
    sent = train.sparkSession.sparkContext.broadcast(vocabulary.arrays())  # at most ``hot`` words

    def run(batches):
        v = Vocabulary.of(*sent.value)
        held = np.zeros(len(v.hashes) + 2)
        for batch, texts in arrow_slices(batches):
            h = lower_words(texts)[1]
            at = v.find(h)
            held[: len(v.hashes)] += np.bincount(at[at >= 0], minlength=len(v.hashes))
            held[-2:] += len(h), len(texts)
        yield _in_blocks(held)

    total = _joined(_summed(train.select("text").mapInArrow(run, "b int, x binary"), 9), len(vocabulary.hashes) + 2)
    vocabulary.rank(total[:-2].astype(np.int64))
    return vocabulary, int(total[-2]), int(total[-1])


def fit(train: DataFrame, vocabulary: Vocabulary, n_words: int, n_docs: int, rounds: int = ROUNDS) -> Model:
    """Every task trains on all of its documents from the same start; the parameters
    are averaged by the tokens seen, ``rounds`` times over alternating halves of the rate."""
    unigram = np.full(SIZE, 0.5)
    known = vocabulary.classes < REST
    unigram[vocabulary.classes[known]] += vocabulary.counts[known]
    unigram[END] += n_docs
    unigram[REST] += n_words - vocabulary.counts[known].sum()
    unigram /= unigram.sum()
    model = Model.start(unigram)
    log_noise = np.log(unigram)
    for k in range(rounds):
        sent = train.sparkSession.sparkContext.broadcast((vocabulary.arrays(), model.flat))

        def run(batches, sent=sent, k=k):
            arrays, flat = sent.value
            vocabulary = Vocabulary.of(*arrays)
            own = Model(flat.copy())
            part = TaskContext.get().partitionId()
            rng, deal = np.random.default_rng([k, part]), np.random.default_rng([rounds, part])
            seen = 0
            for _, texts in arrow_slices(batches):
                _, _, _, c, doc = tokens(texts, vocabulary)
                u, v = contexts(c, doc)
                order = dealt(len(c), k, rounds, deal)
                for first in range(0, len(order), BATCH):
                    at = order[first: first + BATCH]
                    own.step(u[at], v[at], c[at], rng.choice(SIZE, NOISE, p=unigram), log_noise, RATE)
                seen += len(order)
            yield _in_blocks(np.concatenate([own.flat * seen, [seen]]))

        total = _joined(_summed(train.select("text").mapInArrow(run, "b int, x binary"), 4), 0)
        if len(total) and total[-1] > 0:
            model = Model(total[:-1] / total[-1])
    return model


def dealt(n: int, k: int, rounds: int, deal: np.random.Generator) -> np.ndarray:
    """Round ``k``'s share of ``n`` tokens, in random order. All rounds draw from generators of
    the same state, so they share the tokens between them: each is used once."""
    return deal.permutation(n)[k::rounds]


def score(docs: DataFrame, hot: int = HOT, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("held", fold(F.col("doc_id")) == 0).withColumn("row", F.xxhash64("doc_id", "text"))
    train = d.where(~F.col("held"))
    vocabulary, n_words, n_docs = vocabulary_of(train, hot)
    model = fit(train, vocabulary, n_words, n_docs, rounds)
    sent = d.sparkSession.sparkContext.broadcast((vocabulary.arrays(), model.flat, n_docs))

    def run(batches):
        arrays, flat, n_docs = sent.value
        vocabulary = Vocabulary.of(*arrays)
        model = Model(flat)
        logs = np.log10(vocabulary.counts + SMOOTH)
        for batch, texts in arrow_slices(batches):
            n = len(texts)
            at, h, doc, c, token_doc = tokens(texts, vocabulary)
            u, v = contexts(c, token_doc)
            lm = np.bincount(token_doc, model.log_probabilities(u, v, c), n)
            hot = at >= 0
            rest_hot = hot & (vocabulary.classes[at] == REST) if len(vocabulary.classes) else hot
            count = np.bincount(token_doc, minlength=n)
            known = np.bincount(doc[hot], vocabulary.counts[at[hot]] > 0, n) + (n_docs > 0)
            base = np.bincount(doc[hot], logs[at[hot]], n) + np.log10(n_docs + SMOOTH)
            within = np.bincount(doc[rest_hot], logs[at[rest_hot]], n)
            rest = np.bincount(token_doc[c == REST], minlength=n)
            # Words that are not frequent, as (word, times) of each document.
            rare_doc, rare = doc[~hot], h[~hot]
            order = np.lexsort((rare, rare_doc))
            rare_doc, rare = rare_doc[order], rare[order]
            first = np.flatnonzero(np.r_[True, (rare_doc[1:] != rare_doc[:-1]) | (rare[1:] != rare[:-1])]) if len(rare) else np.zeros(0, int)
            times = np.diff(np.r_[first, len(rare)]).astype(np.int32)
            ends = np.r_[0, np.cumsum(np.bincount(rare_doc[first], minlength=n))].astype(np.int32)
            listed = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x)) for x in (rare[first].view(np.int64), times)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in ("doc_id", "held", "row")), *(pa.array(x.astype(np.int64)) for x in (count, known, rest)),
                 *(pa.array(x.astype(np.float64)) for x in (base, within, lm)), *listed],
                ["doc_id", "held", "row", "n_tokens", "n_known", "n_rest", "base", "within", "lm", "words", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    spec = ("doc_id {}, held boolean, row long, n_tokens long, n_known long, n_rest long, base double, within double, lm double, "
            "words array<bigint>, times array<int>").format(kind)
    # The texts are scored once: the sums and the words that are counted after them come from the table.
    found = stored(d.mapInArrow(run, spec))
    own = found.drop("words", "times")
    parts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rare = (found.select("row", "held", F.explode(F.arrays_zip("words", "times")).alias("x"))
            .select(F.col("x.words").alias("w"), "row", "held", F.col("x.times").alias("n")).repartition(parts, "w"))
    count = rare.groupBy("w").agg(F.sum(F.when(F.col("held"), 0).otherwise(F.col("n"))).alias("c"), F.min("row").alias("least"))
    log = F.log10(F.col("c") + SMOOTH)
    # A word's first row tells it apart, so the words are counted with the sums.
    sums = (rare.join(count, "w")
            .groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"), F.sum(F.col("n") * log).alias("logs"),
                                F.sum(F.when((F.col("row") == F.col("least")) & (F.col("c") > 0), 1).otherwise(0)).alias("words")))
    sums = cut(sums)
    repeats = own.groupBy("row").agg(F.count(F.lit(1)).alias("rows"))
    sums = sums.join(repeats, "row").select("row", (F.col("known") / F.col("rows")).cast("long").alias("known"), (F.col("logs") / F.col("rows")).alias("logs"),
                                            (F.col("words") / F.col("rows")).alias("first"))
    rare_words = int(round(sums.agg(F.sum("first")).first()[0] or 0))
    total = n_words + n_docs
    kinds = rare_words + int((vocabulary.counts > 0).sum()) + (n_docs > 0)
    in_rest = n_words - int(vocabulary.counts[vocabulary.classes < REST].sum())
    rest_kinds = kinds - vocabulary.model_words - (n_docs > 0)
    base_total = float(np.log10(total + SMOOTH * (kinds + 1)))
    rest_total = float(np.log10(in_rest + SMOOTH * (rest_kinds + 1)))
    logs = F.coalesce("logs", F.lit(0.0))
    return own.join(sums, "row", "left").select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + logs - F.col("n_tokens") * F.lit(base_total)).alias("base_score"),
        (F.col("lm") + F.col("within") + logs - F.col("n_rest") * F.lit(rest_total)).alias("score"))
