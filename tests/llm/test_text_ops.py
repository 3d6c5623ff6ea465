"""Brute-force and edge tests of the operators on texts."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import collect, make_docs  # noqa: F401
from mentionscope.llm import catalog, decontam, jaccard, lm, quality, suffix_dedup

SF = "/root/testdata/sf0.001"


def corpus(seed=3):
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(400)] + ["the", "of", "and"] * 20

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage = prose(60)
    rows, base = [], prose(120)
    for i in range(60):
        near = base.split()
        for _ in range(rng.randint(0, 4)):
            near[rng.randrange(len(near))] = "x%d" % rng.randrange(10 ** 6)
        rows.append((i, " ".join(near)))
    rows += [(100 + i, prose(rng.randint(1, 12))) for i in range(20)]
    rows += [(200 + i, prose(30) + " " + passage + " " + prose(40)) for i in range(15)]
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "one two"), (304, "ONE  two"), (305, "é" * 40), (306, "aé" * 50), (307, prose(6000)),
             (310, base), (311, base), (311, base), (312, "z" * 300), (313, "z" * 300), (314, "z" * 49)]
    rng.shuffle(rows)
    return rows


def sets(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    s = [sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return sorted((d, len(s[i]), min(least[find(i)])) for i, (d, _) in enumerate(rows))


def test_jaccard_against_brute_force(make_docs):
    rows = corpus()
    got = collect(jaccard.near_duplicates(make_docs(rows, extra=["n", "cls", "key"])), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == brute_components(rows)


def test_nested_sets_at_the_threshold(make_docs):
    """A set of 4k shingles within one of 5k has J = 4/5 exactly: it links."""
    rows = []
    for k in (1, 2, 3, 7, 20, 64):
        w = ["k%dw%d" % (k, i) for i in range(5 * k + 5)]
        rows += [(100 * k, " ".join(w[:5 * k + 4])), (100 * k + 1, " ".join(w[:4 * k + 4])), (100 * k + 2, " ".join(w[:4 * k + 4])),
                 (100 * k + 50, " ".join("far" + x for x in w[:5 * k + 5])), (100 * k + 51, " ".join("far" + x for x in w[:4 * k + 4]))]
    got = collect(jaccard.near_duplicates(make_docs(rows)), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == brute_components(rows)
    assert {d: c for d, _, c in got}[2001] == 2000 and {d: c for d, _, c in got}[2051] == 2051


@pytest.mark.parametrize("short", [2, 16])
def test_long_lists_by_blocks(make_docs, monkeypatch, short):
    """A loose group, none of whose members need be near the first: lists of any length."""
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = random.Random(5)
    base = ["b%d" % i for i in range(150)]
    rows = []
    for i in range(60):
        t = list(base)
        for _ in range(rng.randint(2, 9)):
            t[rng.randrange(150)] = "y%d" % rng.randrange(10 ** 6)
        rows.append((i, " ".join(t)))
    got = collect(jaccard.near_duplicates(make_docs(rows)), "doc_id", "n_shingles", "component_id")
    assert sorted(got) == brute_components(rows)


def test_representatives(make_docs):
    rows = corpus()
    kept = jaccard.representatives(make_docs(rows, extra=["n", "__first2"])).collect()
    want = Counter(c for d, n, c in set(brute_components(rows)) if n and d == c)
    assert sorted(r["doc_id"] for r in kept if sets(r["text"])) == sorted(want)
    assert sum(not sets(r["text"]) for r in kept) == 3
    assert jaccard.near_duplicates(make_docs([])).count() == 0 and jaccard.representatives(make_docs([])).count() == 0
    nulls = collect(jaccard.near_duplicates(make_docs([(None, "a b"), (None, "a b"), (7, "a b"), (None, None)])), "doc_id", "component_id")
    assert nulls == sorted([(None, 7), (None, 7), (7, 7), (None, None)], key=repr)


def brute_repeats(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            first[b[i:i + 50]] = min(first.get(b[i:i + 50], d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < d:
                gone[i + 1:i + 51] = True
        rest = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((d, len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(rest).hexdigest()))
    return sorted(out)


def test_suffix_dedup_against_brute_force(make_docs):
    rows = corpus(9)
    got = suffix_dedup.dedup(make_docs(rows, extra=["t", "kept"]))
    assert sorted(collect(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == brute_repeats(rows)
    assert suffix_dedup.dedup(make_docs([])).count() == 0
    assert {r["n_removed"] for r in suffix_dedup.dedup(make_docs([(None, "q" * 99), (1, "q" * 99), (None, None)])).collect()} == {0}


@pytest.mark.parametrize("many", [2, 20])
def test_crowded_anchors_are_dealt_by_string(make_docs, many):
    """A common line with another neighbour each time: no shard gets more than ``many`` segments of one anchor."""
    rng = random.Random(8)
    rows = corpus(11)
    line = "this very common line stands in a third of all texts"
    for i in range(150):
        a, b = ("".join(rng.choice("abcdefgh") for _ in range(40)) for _ in range(2))
        rows.append((1000 + rng.randrange(150), a + (line if i % 3 else line[8:40] + " tail %d" % (i % 7) * 3) + b))
    docs = make_docs(rows).selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(text) AS t").where("doc_id is not null")
    marks = suffix_dedup.anchor_bitmaps(docs, 1 << 20, many)
    most = [suffix_dedup.distinct_segments(docs, *marks, crowded).groupBy("h").count().agg({"count": "max"}).first()[0] for crowded in (False, True)]
    assert len(marks[2]) and most[0] <= many + 1 < most[1]
    # Rows of one doc_id are one document to the operator, so each id stands once.
    rows = list(dict(rows).items())
    got = suffix_dedup.dedup(make_docs(rows), many)
    assert sorted(collect(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == brute_repeats(rows)


def test_tiny_bitmaps_and_pieces_lose_no_repeat(make_docs, monkeypatch):
    """64 slots for all anchors (every one collides), two slots a block: the same result."""
    for name, value in (("LEAST_BITS", 6), ("MOST_BITS", 6), ("BLOCK_BITS", 3), ("MOST_BLOCKS", 3)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = corpus(13)
    assert sorted(collect(suffix_dedup.dedup(make_docs(rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == brute_repeats(rows)


def test_slot_marks_compare_all_64_bits():
    """Texts and segments that agree in either half of their hash are still different ones."""
    low, high = 7, 7 + (1 << 40)
    h = np.sort(np.array([1 << 61, 1 << 61, 1 << 60, 1 << 60, 3 << 60, 3 << 60], np.uint64)).view(np.int64)
    t = np.array([low, high, low, low, low, high])
    k = np.array([low, low, high, low, low, high])
    batches = [pa.RecordBatch.from_arrays([pa.array(x[i:i + 1]) for x in (h, t, k)], ["h", "t", "k"]) for i in range(6)]
    marks = {b.column("block")[0].as_py(): b for b in suffix_dedup.slot_marks(iter(batches), 8, 4, 99)}
    bits = {n: [b.column(c)[0].as_py() != bytes(2) for c in ("shared", "mixed")] for n, b in marks.items()}
    assert bits == {1: [True, False], 2: [False, True], 3: [True, True]}


def test_long_texts_in_pieces_hold_every_string_once():
    raw = bytes(random.Random(5).choices(b"abcdefgh ", k=5000))
    texts = [raw, b"", raw[:49], raw[100:2300]]
    whole, cut = (suffix_dedup.segments(texts, piece)[:5] for piece in (1 << 20, 300))
    for doc, a, b, *_ in (whole, cut):
        starts = sorted((d, p) for d, x, y in zip(doc.tolist(), a.tolist(), b.tolist()) for p in range(x, y - 49))
        assert starts == [(d, p) for d, t in enumerate(texts) for p in range(len(t) - 49)]
    anchors = [{(d, p): h for d, x, y, h, _ in zip(*(v.tolist() for v in found)) for p in range(x, y - 49)} for found in (whole, cut)]
    assert anchors[0] == anchors[1]


def test_suffix_ranks_tell_suffixes_apart():
    data = np.frombuffer(bytes(random.Random(1).choices(b"ab", k=3000)) + bytes(64), np.uint8)
    sa, _ = suffix_dedup.suffix_ranks(data)
    raw = data.tobytes() + bytes(72)
    keys = [raw[i:i + 64] for i in sa]
    assert keys == sorted(keys) and sorted(sa) == list(range(len(data)))


def test_suffix_dedup_sql_on_the_small_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(suffix_dedup.ORACLE_SQL)
    cols = want.columns
    assert collect(catalog.op6_suffix_dedup(spark, SF), *cols) == sorted(want.fetchall(), key=repr)


def brute_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_against_brute_force(make_docs, spark):
    rng = random.Random(4)
    items = ["".join(rng.choice("abcde fgh") for _ in range(n)).strip() + "x" for n in (40, 90, 150, 300)]
    bench = spark.createDataFrame([*enumerate(items), (7, None), (8, ""), (9, "short one"), (10, items[0])], "item_id long, text string")
    rows = []
    for i in range(60):
        item = list(rng.choice(items))
        for _ in range(rng.randint(0, 1 + len(item) // 9)):
            k = rng.randrange(len(item))
            item[k:k + rng.randint(0, 1)] = rng.choice(["", "q", "zz"])
        rows.append((i, "Start of  it " + "".join(item).upper() + "\nand the end"))
    rows += [(90, None), (91, ""), (92, "clean text " * 9), (92, "clean text " * 9), (None, items[1])]
    docs = make_docs(rows, extra=["item_id", "edits"])
    for chars in (10 ** 6, 60):
        got = {(r["doc_id"], r["item_id"]): r for r in decontam.find(docs, bench, block_chars=chars).collect()}
        want = {}
        for d, t in rows:
            for k, item in [*enumerate(items), (10, items[0])]:
                e = brute_edits(decontam.plain(item.encode()), decontam.plain((t or "").encode()))
                if e <= int(decontam.RATE * len(decontam.plain(item.encode()))):
                    want[d, k] = e
        assert {k: r["edits"] for k, r in got.items()} == want
    left = decontam.clean(docs, bench)
    assert sorted(collect(left, "doc_id"), key=repr) == sorted([(d,) for d, t in rows if (d, 0) not in want and all((d, k) not in want for k in range(5))], key=repr)
    assert decontam.find(docs, bench.where("false")).count() == 0 and decontam.clean(make_docs([]), bench).count() == 0


def test_short_items_are_found_word_for_word(make_docs, spark):
    bench = spark.createDataFrame([(1, "What is 2+2?"), (2, "Paris"), (3, " \n"), (4, "?!"), (5, "\u4e2d\u6587\u9898"), (6, "blue  Whale song")], "item_id long, text string")
    rows = [(1, "Q: what  is 2+2? four"), (2, "comparison of parisian plays"), (3, "(PARIS)"), (4, "really?! yes"), (5, "a ?! b"),
            (6, "x\u8fd9\u4e2d\u6587\u9898\u662f"), (7, "a blue\twhale song"), (8, "a blue whale sang"), (9, "paris"), (10, "parisian paris"), (11, "blue whale songs")]
    for chars in (10 ** 6, 20):
        got = decontam.find(make_docs(rows), bench, block_chars=chars).collect()
        assert {(r["doc_id"], r["item_id"], r["edits"], r["budget"]) for r in got} == {(d, i, 0, 0) for d, i in ((1, 1), (3, 2), (5, 4), (6, 5), (7, 6), (9, 2), (10, 2))}
    at = {r["doc_id"]: (r["first_char"], r["last_char"]) for r in got}
    assert at[10] == (9, 14) and at[3] == (1, 6)
    assert collect(decontam.clean(make_docs(rows), bench), "doc_id") == [(11,), (2,), (4,), (8,)]


def test_lm_base_and_normalised_probabilities(make_docs):
    rows = corpus(2)
    got = lm.score(make_docs(rows, extra=["row", "held"]), hot=50).collect()
    counts = Counter()
    tok = lambda t: (t or "").encode().lower().split() + [None]
    for d, t in rows:
        if zlib.crc32(str(d).encode()) % 10:
            counts.update(tok(t))
    n, z = sum(counts.values()), math.log10(sum(counts.values()) + 0.1 * (len(counts) + 1))
    text = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        w = tok(text[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
        assert math.isclose(r["base_score"], sum(math.log10(counts[x] + 0.1) - z for x in w), rel_tol=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0
    model = lm.Model.start(np.full(lm.SIZE, 1 / lm.SIZE))
    u, v = np.full(lm.SIZE, 3), np.full(lm.SIZE, 5)
    assert math.isclose((10 ** model.log_probabilities(u, v, np.arange(lm.SIZE))).sum(), 1, rel_tol=1e-5)
    assert lm.score(make_docs([])).count() == 0


def test_lm_learns_a_chain_in_one_pass():
    """50,000 tokens in steps of the module's batch and noise: -1.99 by 48 and 2,048, -2.16 by 32 and 4,096."""
    rng = np.random.default_rng(0)
    follow = rng.permutation(lm.SIZE)
    jump, c = rng.random(60000) < 0.3, rng.integers(0, lm.SIZE, 60000)
    c[0] = 0
    for i in range(1, 60000):
        if not jump[i]:
            c[i] = follow[c[i - 1]]
    u, v, unigram = np.r_[0, 0, c[:-2]], np.r_[0, c[:-1]], np.full(lm.SIZE, 1 / lm.SIZE)
    model = lm.Model.start(unigram)
    for first in range(0, 50000, lm.BATCH):
        a = slice(first, min(first + lm.BATCH, 50000))
        model.step(u[a], v[a], c[a], rng.choice(lm.SIZE, lm.NOISE, p=unigram), np.log(unigram), lm.RATE)
    assert model.log_probabilities(u[50000:], v[50000:], c[50000:]).mean() > -2.07


def _kneser_ney(counts, size):
    """Interpolated modified Kneser-Ney by dictionaries: p(w | u, v) of every trigram."""
    def discount(table):
        n = [0] + [sum(c == k for c in table.values()) for k in (1, 2, 3, 4)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        d = [min(max(k - (k + 1) * y * n[k + 1] / n[k] if n[k] else y * k, 0.05 * k), 0.95 * k) for k in (1, 2, 3)]
        return lambda c: d[min(c, 3) - 1]

    two = Counter((v, w) for _, v, w in counts)
    one = Counter(w for _, w in two)
    d3, d2, d1 = discount(counts), discount(two), discount(one)(1)
    total = sum(one.values())

    def p1(w):
        return (max(one[w] - d1, 0) if w in one else 0) / total + d1 * len(one) / total / size

    def level(table, d, context, key, lower):
        seen = {k: c for k, c in table.items() if k[:-1] == context}
        if not seen:
            return lower
        n = sum(seen.values())
        return (seen[key] - d(seen[key]) if key in seen else 0) / n + sum(d(c) for c in seen.values()) / n * lower

    return {(u, v, w): level(counts, d3, (u, v), (u, v, w), level(two, d2, (v,), (v, w), p1(w)))
            for u in range(size) for v in range(size) for w in range(size)}


def test_kneser_ney_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    size = 9
    for draws in (5, 60, 400):
        u, v, w = (rng.integers(0, size, draws) ** 2 // size for _ in range(3))
        counts = Counter(zip(u.tolist(), v.tolist(), w.tolist()))
        rows = spark.createDataFrame([(*k, c) for k, c in counts.items()], "u int, v int, w int, c long")
        a, b, c = (x.ravel() for x in np.indices((size, size, size)))
        got = 10 ** quality.model(rows, size).log_probabilities(a, b, c)
        want = _kneser_ney(counts, size)
        assert np.allclose(got, [want[k] for k in zip(a.tolist(), b.tolist(), c.tolist())], rtol=1e-9, atol=0)
        assert np.allclose(got.reshape(size, size, size).sum(2), 1)


def test_scores_of_whole_texts_equal_brute_force(spark, make_docs):
    """Tokens, spelling and sums of a text against plain loops over its words."""
    trusted = ["the cat sat on the mat. The cat ran, the dog sat", "a dog and a cat met; the mat was on the floor 12 34", "odd words: zyx qwv the the end"]
    known, grams, spelling = quality.fit(make_docs(list(enumerate(trusted))))
    model, place = quality.Model(*grams), quality.Keys(known)
    texts = ["the cat met the zebra zebra zebra.", "", "   ", "the", "Dog the the THE caf\u00e9 " + "x" * 3000, "the cat " * 4000]
    n, new, lp = quality.Scorer(known, grams, spelling).score([t.encode() for t in texts])

    def stem(word):
        b = word.encode()
        b = bytes([b[0] + 32]) + b[1:] if 65 <= b[0] <= 90 else b
        return b[:-1] if len(b) > 1 and chr(b[-1]) in ",.;:?" else b

    for i, text in enumerate(texts):
        u = v = quality.END
        before, total, repeats, count = None, 0.0, 0, 0
        for word in text.split():
            s = stem(word)
            at = int(place.find(quality.split([s])[4])[0])
            own = at + quality.WORDS if at >= 0 else quality.UNKNOWN
            token = quality.REPEAT if s == before else own
            total += float(model.log_probabilities(*(np.array([x]) for x in (u, v, token)))[0])
            if token == quality.UNKNOWN:
                k = [quality.EDGE] * 2 + [int(quality._CLASS[x]) for x in word.encode()] + [quality.EDGE]
                total += max(quality.WORST, sum(float(spelling[(k[j - 2] * quality.LETTERS + k[j - 1]) * quality.LETTERS + k[j]]) for j in range(2, len(k))))
            repeats, count, u, v, before = repeats + (token == quality.REPEAT), count + 1, v, own, s
        total += float(model.log_probabilities(np.array([u]), np.array([v]), np.array([quality.END]))[0])
        assert (n[i], new[i]) == (count + 1, count + 1 - repeats)
        assert abs(lp[i] - total) < 1e-6 * max(1, abs(total))
    assert n[4] == 7 and new[4] == 6                      # "THE" is another word than "the"


def test_places_of_keys():
    rng = np.random.default_rng(8)
    for size in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 62, size))
        rng.shuffle(keys)
        table = quality.Keys(keys)
        assert (table.find(keys) == np.arange(len(keys))).all()
        other = np.setdiff1d(rng.integers(0, 1 << 62, 1000), keys)
        assert (table.find(other) == -1).all()


def test_quality_rejects_random_letters(spark):
    """Trusted documents with 80 % of their words replaced by random letters of the same case and length."""
    rnd = random.Random(1)

    def scrambled(word):
        return "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c.isupper() else "abcdefghijklmnopqrstuvwxyz") if c.isalpha() else c for c in word)

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select("doc_id", "lang", "text")
    good = [r for r in docs.join(labels.where("quality = 1"), "doc_id", "left_semi").orderBy("doc_id").collect() if len((r["text"] or "").split()) >= 30][:60]
    junk = [(10 ** 9 + r["doc_id"], r["lang"], " ".join(scrambled(w) if rnd.random() < 0.8 else w for w in r["text"].split())) for r in good]
    both = docs.union(spark.createDataFrame(junk, "doc_id long, lang string, text string"))
    kept = quality.classify(both, labels).where("doc_id >= 1000000000").select("kept").collect()
    assert len(kept) == len(junk) and sum(r["kept"] for r in kept) <= 0.1 * len(junk)


def test_quality_keeps_trusted_and_rejects_junk(spark, make_docs):
    got = {r["doc_id"]: r["kept"] for r in catalog.op9_quality(spark, "/root/testdata/sf0.01").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    wrong = [d for d, q in labels.items() if got[d] != (q == 1)]
    assert len(wrong) <= 0.02 * len(labels)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs([(1, "a b c " * 30), (2, None, None), (None, "", "xx"), (3, "x"), (3, "x")], extra=["kept", "threshold", "n_tokens"])
    out = quality.classify(docs, labels).collect()
    assert len(out) == 5 and all(r["kept"] for r in out)
    assert quality.classify(make_docs([]), labels).count() == 0
    assert all(r["kept"] for r in quality.classify(docs, labels.where("false")).collect())


def test_rounds_of_training_share_all_tokens():
    import numpy as np
    from mentionscope.llm import lm
    for rounds in (1, 2, 3):
        deals = [np.random.default_rng([rounds, 5]) for _ in range(rounds)]
        for n in (0, 1, 7, 1000):                     # slice after slice of one task
            used = np.concatenate([lm.dealt(n, k, rounds, deals[k]) for k in range(rounds)])
            assert sorted(used) == list(range(n))


def test_span_hashes_are_the_word_hashes():
    import random
    from mentionscope.llm import common
    rnd = random.Random(2)
    cases = [[bytes(rnd.choice(b"ab \n\tAZ\xc3\xa9") for _ in range(rnd.choice([0, 1, 5, 40]))) for _ in range(rnd.choice([1, 2, 7]))] for _ in range(200)]
    cases += [[b"x" * 300_000 + b" y " + b"ab " * 100_000, b"", b"q" * common.SPAN + b" z"], [], [b""]]
    for texts in cases:
        _, _, _, doc, h = common.words(texts)
        d, g = common.lower_words(texts)
        assert doc.tolist() == d.tolist() and h.tolist() == g.tolist()


def test_quality_fits_on_every_trusted_document(make_docs, spark):
    """Words that one trusted document holds are known, however many there are and however long it is."""
    docs = make_docs([(i, f"word{i} word{i} " + ("long " * 70_000 if i == 7 else "")) for i in range(3000)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(3000)], "doc_id long, quality int, toxic int")
    fitted = {r["doc_id"] for r in quality.trusted_documents(docs, labels).select("doc_id").collect()}
    rest = {r["doc_id"] for r in labels.where(quality.held_back("doc_id")).collect()}
    assert fitted == set(range(3000)) - rest and 7 in fitted | rest and 800 < len(rest) < 1200
    known = quality.Keys(quality.fit(quality.trusted_documents(docs, labels))[0])
    assert (known.find(quality.split([f"word{i}".encode() for i in sorted(fitted)])[4]) >= 0).all()


def test_rare_ngrams_leave_their_mass_to_the_lower_order(spark):
    rng = np.random.default_rng(4)
    size = 9
    u, v, w = (rng.integers(0, size, 400) ** 2 // size for _ in range(3))
    rows = spark.createDataFrame([(*k, c) for k, c in Counter(zip(u.tolist(), v.tolist(), w.tolist())).items()], "u int, v int, w int, c long")
    a, b, c = (x.ravel() for x in np.indices((size, size, size)))
    m = quality.model(rows, size, entries=20)
    assert 0 < len(m.triples) <= 20
    assert np.allclose((10 ** m.log_probabilities(a, b, c)).reshape(size, size, size).sum(2), 1)


def test_lm_reads_the_texts_once_to_score_them(make_docs, spark):
    """Four passes count and train, one scores."""
    rows = [(i, f"some words of text {i} and word{i % 7}") for i in range(40)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    docs = make_docs(rows)
    got = lm.score(docs.mapInArrow(counted, docs.schema), hot=5).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(40))
    assert read.value == 5 * len(rows)


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_")}


def test_components_leave_no_shuffle_and_few_partitions(spark, monkeypatch):
    from mentionscope.llm import components as module
    rng = np.random.default_rng(6)
    pairs = [(int(a) - 40, int(b) - 40) for a, b in rng.integers(0, 120, (60, 2))] + [(i, i + 1) for i in range(200, 260)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    written = []

    def cut(df):
        out = module_cut(df)
        written.append(out.rdd.getNumPartitions())
        return out

    module_cut = module.cut
    monkeypatch.setattr(module, "cut", cut)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "23"}
    held = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        links = spark.createDataFrame(pairs, "u long, v long")
        for rows, most in ((1 << 18, 1), (50, 3)):
            before = _shuffle_files(spark)
            got = module.components(links, rows)
            assert _shuffle_files(spark) <= before
            assert 1 <= max(written[1:]) <= most
            assert sorted((r["node"], r["component"]) for r in got.collect()) == sorted((x, find(x)) for x in root)
            written.clear()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_sketch_blocks_take_the_bytes_they_need():
    for most, width in ((0, 1), (255, 1), (256, 2), (65_536, 4), (2 ** 32 - 1, 4), (2 ** 32, 8)):
        n = np.zeros(jaccard.SLOT_BLOCK, np.int64)
        n[3] = most
        raw = jaccard._pack(n)
        assert len(raw) == width * len(n) and (jaccard._unpack(raw) == n).all()


def test_fit_leaves_no_shuffle(make_docs, spark):
    trusted = make_docs([(i, f"a good text of words and more words, number {i % 9}") for i in range(60)])
    before = _shuffle_files(spark)
    known, grams, spelling = quality.fit(trusted)
    assert len(known) and len(grams[0]) and len(spelling) == quality.LETTERS ** 3
    assert _shuffle_files(spark) <= before
