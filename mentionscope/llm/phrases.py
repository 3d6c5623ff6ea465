"""Collocations: word phrases that stand together more often than their parts.

The counts come from suffix trees over words, cut at the depth of the longest phrase and
partitioned by prefix, so that no tree outgrows a memory budget:

1. *Vertical partitioning.* First words are counted; a word with more occurrences than the
   budget is too large a prefix and is extended by the word behind it, and a pair that is
   still too large by one more word, and so on. A prefix of full depth is a single leaf,
   which every task adds up before it sends it.
2. *Grouping.* The prefixes lie on a line by their hash, which is cut where their occurrences
   reach the budget; each stretch is a group.
3. *Subtrees.* Each task sends every group its suffixes, cut at the depth, as distinct rows
   with counts; a group sorts them, which is its subtree, and sums leaf totals upwards. Nodes
   above a group's prefix (words and pairs that were too large) are partial sums, which are
   added over the groups.

Words travel as text, hashes only say where; two words of one hash are counted apart.
Scores, the removal of phrases within longer ones and the ranks are joins over the counts.

Everything is per language. Edge cases: null text is empty, a null language is ``und``; pieces
without words give nothing; equal scores are ordered by count, then by the phrase's bytes; repeated
rows count as often as they stand there; texts of any length are cut into windows that overlap by
a phrase less one word, so no occurrence is lost; an empty table gives an empty result; other
columns are not read. Scores are exact for counts up to 10^16.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, arrow_slices, mix64, shuffles_removed, stored, word_hashes

LONGEST = 3                 # words of the longest phrase
LEAST = 10                  # occurrences of a phrase
COVERED = 50                # a phrase goes when a longer one holds so many percent of its occurrences
TOP = 2000                  # phrases reported per language

BUDGET = 1 << 19            # suffixes in a group
MOST_GROUPS = 1 << 19       # the budget grows where the input would need more groups
MOST_BITS = 21              # the line of prefixes is summed in at most 2^21 bins
WINDOW = 4 << 20            # bytes of text taken apart at once

_BREAK = b"\xff"            # no byte of UTF-8; stands for the end of a piece
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(0xFF if i in _BREAKS else i + 32 if 65 <= i <= 90 else i for i in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_END = np.uint64(0x5851F42D4C957F2D)


def windows(texts: list[bytes], depth: int, limit: int = WINDOW) -> Iterator[tuple[list[bytes], int]]:
    """(tokens, owned): the words of the texts with a break between pieces, where suffixes
    start at the first ``owned`` tokens and the others stand behind them."""
    data = _BREAK.join(texts).translate(_TABLE).replace(_BREAK, b" " + _BREAK + b" ")
    at, carried = 0, []
    while at < len(data):
        end = data.find(b" ", at + limit) if at + limit < len(data) else -1
        end = len(data) if end < 0 else end
        tokens = carried + data[at:end].split()
        at = end
        if at < len(data):
            owned = max(0, len(tokens) - depth + 1)
            carried = tokens[owned:]
        else:
            owned = len(tokens)
            tokens += [_BREAK] * (depth - 1)
        if owned:
            yield tokens, owned


def suffixes(tokens: list[bytes], owned: int, depth: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, codes, counts): the distinct suffixes as rows of word numbers, -1 behind a piece's end."""
    import pandas as pd
    # The break is the first token, so its number is 0 and words count from 1.
    codes, found = pd.factorize(np.array([_BREAK, *tokens], dtype=object))
    codes = codes[1:].astype(np.int64)
    columns = [codes[j:j + owned] for j in range(depth)]
    for j in range(1, depth):
        columns[j] = np.where(columns[j - 1] == 0, 0, columns[j])
    rows = np.stack(columns, 1)[columns[0] > 0]
    return list(found[1:]), *distinct(rows - 1, np.ones(len(rows), np.int64), len(found))


def distinct(rows: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows (numbers from -1 to n - 1) sorted, each once, with the sums of their counts."""
    if not len(rows):
        return rows, counts
    key = rows[:, 0] + 1
    size = n + 1
    for j in range(1, rows.shape[1]):
        if size > (1 << 62) // (n + 1):
            key = np.unique(key, return_inverse=True)[1]
            size = len(key)
        key = key * (n + 1) + rows[:, j] + 1
        size *= n + 1
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return rows[order[first]], np.add.reduceat(counts[order], first)


def hashes_of(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    return word_hashes(np.frombuffer(b"".join(words), np.uint8), starts, ends) if len(words) else np.zeros(0, np.uint64)


def prefixes(words: list[bytes], rows: np.ndarray, lang: str) -> list[np.ndarray]:
    """Hash of the first 1, 2, .. words of each suffix within its language."""
    own = hashes_of([lang.encode() + b" "])
    each = np.concatenate([hashes_of(words), [_END]])
    out, h = [], own
    for j in range(rows.shape[1]):
        h = mix64(h * _ODD + each[rows[:, j]])
        out.append(h)
    return out


def inside(sorted_set: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def _by_lang(batches) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of small slices of the batches, a language at a time."""
    for batch, texts in arrow_slices(batches, limit=WINDOW):
        langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        by: dict[str, list[bytes]] = {}
        for lang, text in zip(langs, texts, strict=True):
            by.setdefault(lang, []).append(text)
        yield from by.items()


class _Sums:
    """Counts by hash, added up in memory and given out when they are many."""

    def __init__(self, most: int = 1 << 20):
        self.parts, self.held, self.most = [], 0, most

    def add(self, keys: np.ndarray, counts: np.ndarray):
        self.parts.append((keys, counts))
        self.held += len(keys)
        if self.held > 2 * self.most:
            keys, counts = self.merged()
            if len(keys) > self.most:
                self.parts, self.held = [], 0
                return keys, counts
            self.parts, self.held = [(keys, counts)], len(keys)
        return None

    def merged(self):
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys = np.concatenate([k for k, _ in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in self.parts])[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.add.reduceat(counts, first)


def prefix_counts(docs: DataFrame, heavy: list[np.ndarray], depth: int) -> DataFrame:
    """``lang, prefix, n``: occurrences of each prefix of ``len(heavy) + 1`` words (hash; lang null)
    that extends one of the last of ``heavy``, and with no ``heavy`` each language's words (prefix null)."""
    level = len(heavy)

    def count(batches):
        import pyarrow as pa
        sums, words_of = _Sums(), {}

        def out(langs, keys, counts):
            return pa.RecordBatch.from_arrays([langs, keys, pa.array(counts, pa.int64())], names=["lang", "prefix", "n"])

        def prefixed(keys, counts):
            return out(pa.nulls(len(keys), pa.string()), pa.array(keys.view(np.int64)), counts)

        for lang, texts in _by_lang(batches):
            for tokens, owned in windows(texts, depth):
                words, rows, counts = suffixes(tokens, owned, depth)
                if not len(rows):
                    continue
                if not level:
                    words_of[lang] = words_of.get(lang, 0) + int(counts.sum())
                at = prefixes(words, rows[:, :level + 1], lang)
                wide = np.ones(len(rows), bool)
                for j in range(level):      # extended only where every shorter prefix is too large and goes on
                    wide &= inside(heavy[j], at[j])
                if wide.any() and (full := sums.add(at[level][wide], counts[wide])):
                    yield prefixed(*full)
        yield prefixed(*sums.merged())
        yield out(pa.array(list(words_of), pa.string()), pa.nulls(len(words_of), pa.int64()), list(words_of.values()))

    rows = docs.mapInArrow(count, "lang string, prefix long, n long")
    return rows.groupBy("lang", "prefix").agg(F.sum("n").alias("n"))


def partition(docs: DataFrame, depth: int, budget: int = BUDGET) -> tuple[DataFrame, list[np.ndarray], np.ndarray]:
    """(``lang, n``, heavy, groups): the words of each language, the hashes of the prefixes of 1, 2, ..
    words that are too large, and the group of each bin of the line of prefix hashes.

    Both arrays are bounded: at most 1/budget of all suffixes start with a prefix that is too large,
    and the budget is at least 1/MOST_GROUPS of them; the line has at most 2^MOST_BITS bins."""
    spark = docs.sparkSession
    levels = [stored(prefix_counts(docs, [], depth))]
    totals = levels[0].where("lang IS NOT NULL").select("lang", "n")
    total = totals.agg(F.sum("n")).first()[0] or 0
    budget = max(budget, -(-total // MOST_GROUPS))
    heavy: list[np.ndarray] = []
    while len(heavy) < depth - 1:
        large = levels[-1].where(F.col("prefix").isNotNull() & (F.col("n") > budget)).select("prefix").toArrow()
        heavy.append(np.sort(large.column(0).to_numpy().view(np.uint64)))
        if not len(heavy[-1]):
            break
        if len(heavy) < depth - 1:      # prefixes of full depth are leaves and need no count
            levels.append(stored(prefix_counts(docs, heavy, depth)))
    while len(heavy) < depth - 1:
        heavy.append(np.zeros(0, np.uint64))
    bits = min(MOST_BITS, max(8, int(8 * total // budget).bit_length()))
    line = None
    for level in levels:
        light = level.where(F.col("prefix").isNotNull() & (F.col("n") <= budget))
        line = light if line is None else line.unionByName(light)
    sums = line.groupBy(F.shiftrightunsigned("prefix", 64 - bits).alias("bin")).agg(F.sum("n").alias("n")).toArrow()
    weight = np.zeros(1 << bits, np.int64)
    weight[sums.column("bin").to_numpy()] = sums.column("n").to_numpy()
    groups = ((np.cumsum(weight) - weight) // budget).astype(np.int32)
    return totals, heavy, groups


def phrase_counts(docs: DataFrame, depth: int = LONGEST, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(``lang, size, phrase, n`` of every phrase of 1 to ``depth`` words with ``least`` occurrences,
    ``lang, n`` with the words of each language)."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    totals, heavy, groups = partition(docs, depth, budget)
    shared = spark.sparkContext.broadcast((heavy, groups))
    shift = np.uint64(64 - (len(groups).bit_length() - 1))

    def deal(batches):
        import pyarrow as pa
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
        names = ["part", "above", "lang", "words", "codes", "counts"]
        heavy, groups = shared.value
        for lang, texts in _by_lang(batches):
            for tokens, owned in windows(texts, depth):
                words, rows, counts = suffixes(tokens, owned, depth)
                if not len(rows):
                    continue
                at = prefixes(words, rows, lang)
                place, above = at[0], np.zeros(len(rows), np.int32)
                wide = np.ones(len(rows), bool)
                for j in range(depth - 1):
                    wide &= inside(heavy[j], at[j])
                    place = np.where(wide, at[j + 1], place)
                    above += wide       # nodes of so many words are spread over groups
                part = groups[(place >> shift).astype(np.int64)]
                order = np.lexsort((part, above))
                part, above, rows, counts = part[order], above[order], rows[order], counts[order]
                edges = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (above[1:] != above[:-1]), [True]]))
                sent = []
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    own = rows[a:b]
                    known = np.unique(own[own >= 0])
                    local = np.where(own >= 0, np.searchsorted(known, own), -1).astype(np.int32)
                    sent.append((int(part[a]), int(above[a]), lang, b" ".join([words[w] for w in known]), local.tobytes(), counts[a:b].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*sent, strict=True), kinds, strict=True)], names=names)

    def subtree(key, table):
        import pyarrow as pa
        above, lang = key[1].as_py(), key[2].as_py()
        numbers: dict[bytes, int] = {}
        rows, counts = [], []
        for text, codes, n in zip(table.column("words"), table.column("codes"), table.column("counts"), strict=True):
            local = np.array([numbers.setdefault(w, len(numbers)) for w in text.as_py().split(b" ")] + [-1], np.int64)
            rows.append(local[np.frombuffer(codes.as_py(), np.int32).reshape(-1, depth)])
            counts.append(np.frombuffer(n.as_py(), np.int64))
        # Leaves in order; the runs of equal first words are the nodes above them.
        rows, counts = distinct(np.concatenate(rows), np.concatenate(counts), len(numbers))
        words = list(numbers)
        size, phrase, total = [], [], []
        fresh = np.zeros(len(rows), bool)
        fresh[0] = True
        for d in range(1, depth + 1):
            fresh[1:] |= rows[1:, d - 1] != rows[:-1, d - 1]
            first = np.flatnonzero(fresh)
            sums = np.add.reduceat(counts, first)
            kept = (rows[first, d - 1] >= 0) & ((sums >= least) | (d <= above))
            size += [d] * int(kept.sum())
            phrase += [b" ".join([words[w] for w in r]) for r in rows[first[kept], :d]]
            total += sums[kept].tolist()
        text = pa.array(phrase, pa.binary()).cast(pa.string())
        return pa.table([pa.array([lang] * len(size), pa.string()), pa.array(size, pa.int32()), text, pa.array(total, pa.int64())],
                        names=["lang", "size", "phrase", "n"])

    sent = docs.mapInArrow(deal, "part int, above int, lang string, words binary, codes binary, counts binary")
    nodes = sent.groupBy("part", "above", "lang").applyInArrow(subtree, "lang string, size int, phrase string, n long")
    return nodes.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least), totals


def collocations(docs: DataFrame, depth: int = LONGEST, least: int = LEAST, covered: int = COVERED, budget: int = BUDGET) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of every phrase of 2 to ``depth`` words that no longer one covers."""
    counts, totals = phrase_counts(docs, depth, least, budget)
    counts = stored(counts)
    words = F.split("phrase", " ")
    found = counts.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("__l"),
                       F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " ").alias("__r"))
    part = lambda side: counts.select("lang", F.col("phrase").alias(f"__{side}"), F.col("n").alias(side))
    cuts = cuts.join(part("l"), ["lang", "__l"]).join(part("r"), ["lang", "__r"])
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("__aa", F.lit(1_000_000).cast("decimal(7,0)") * whole("a") * whole("a")).withColumn("__lr", whole("l") * whole("r"))
    cuts = cuts.withColumn("score", F.expr("__aa div __lr"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("b"))
    best = best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.score")
    # Each phrase within a longer one, with the most occurrences of such a longer one.
    longer = found.where("size > 2").withColumn("__s", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    longer = longer.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("__s") + 1)))
    within = (longer.select("lang", F.array_join(F.slice(words, F.col("__i"), F.col("__s")), " ").alias("phrase"), F.col("a").alias("__f"))
                    .groupBy("lang", "phrase").agg(F.max("__f").alias("__f")))
    best = best.join(within, ["lang", "phrase"], "left")
    best = best.where(F.col("__f").isNull() | (F.lit(100).cast("decimal(3,0)") * whole("__f") < F.lit(covered).cast("decimal(3,0)") * whole("a")))
    return best.drop("__f").join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def top_collocations(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    """The contract's rows: the first ``top`` of :func:`collocations` per language, ranked."""
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = collocations(docs, **options).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, (SELECT unnest(range(1, {LONGEST} + 1)) AS k)),
c AS (SELECT lang, k AS size, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE size = 1 GROUP BY lang),
x AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS ws FROM c WHERE size > 1 AND f >= {LEAST}),
k AS (SELECT *, unnest(range(1, size)) AS k FROM x),
s AS (SELECT k.lang, k.phrase, k.size, a, k, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
      FROM k JOIN c l ON l.lang = k.lang AND l.phrase = array_to_string(k.ws[1:k.k], ' ')
             JOIN c r ON r.lang = k.lang AND r.phrase = array_to_string(k.ws[k.k + 1:k.size], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, a AS f FROM x WHERE size = 3
      UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), a FROM x WHERE size = 3),
m AS (SELECT lang, phrase, max(f) AS f FROM o GROUP BY ALL),
e AS (SELECT b.* FROM b LEFT JOIN m ON b.lang = m.lang AND b.phrase = m.phrase WHERE m.f IS NULL OR 100 * m.f < {COVERED} * b.a),
q AS (SELECT e.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM e)
SELECT q.lang, rank, phrase, a, l, r, t.n, score::BIGINT AS score FROM q JOIN t ON q.lang = t.lang WHERE rank <= {TOP}
"""
