import hashlib
import zlib

from llm_helpers import make_docs  # noqa: F401
from mentionscope.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, changed=False):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    if changed and values[4] is not None:
        values[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in values[4])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def up(levels, i):
    """Per level (digests before, digests behind) of the node above leaf i."""
    out = []
    for level in levels[:-1]:
        first = i // 8 * 8
        out.append(("".join(level[first:i]), "".join(level[i + 1:first + 8])))
        i //= 8
    return out


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang, own in langs.items():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[lang] = tree([leaf(r) for r in own])
    top = tree([trees[lang][-1][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for i, r in enumerate(langs[lang]):
            path = up(trees[lang], i) + up(top, k)
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            at = leaf(r, tampered)
            for left, right in path:
                at = sha(left + at + right)
            out.append((r["doc_id"], leaf(r), trees[lang][-1][0], top[-1][0], sha("".join(x + y for x, y in path)), at, at == top[-1][0]))
    return sorted(out, key=repr)


ROWS = ([(i, f"Text {i} É", ["en", "de", None][i % 7 % 3], "a") for i in range(90)] + [(200, "no capitals", "fr", None), (None, None, "fr", "b"), (None, "Zwei", "en", "b")]
        + [(5, "Again", "en", "a")] * 20 + [(300, "", "és", ""), (301, "X" * 200_000, "en", "long"), (-7, "Minus", "de", "a")])


def test_equal_to_brute_force(make_docs, spark):
    docs = make_docs(ROWS, extra=["root", "leaf", "tree", "idx", "n"])
    got = [tuple(r) for r in merkle.manifest(docs).collect()]
    assert sorted(got, key=repr) == brute([r.asDict() for r in docs.collect()])
    assert {r[6] for r in got} == {True, False}


def test_many_trees_and_lone_leaves(make_docs, spark):
    rows = [(i, f"T{i}", f"l{i:03d}") for i in range(70)]          # each language one leaf, the upper tree three levels
    docs = make_docs(rows)
    assert sorted((tuple(r) for r in merkle.manifest(docs).collect()), key=repr) == brute([r.asDict() for r in docs.collect()])
    one = make_docs([(4, "One", None)])
    r = merkle.manifest(one).collect()[0]
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == sha("")


def test_empty(make_docs, spark):
    assert merkle.manifest(make_docs([])).collect() == []


def test_wanted_leaves_only(make_docs, spark):
    """A descent for a few requests opens only their nodes and finds the same paths."""
    docs = make_docs([(i, f"t{i}", "en") for i in range(600)])
    rows = merkle.stored(merkle.ranked(merkle.leaves(docs), ["doc_id", "leaf"]))
    graph = merkle.build(rows.selectExpr("tree", "idx", "n", "leaf AS digest"))
    starts = graph.tops.selectExpr("tree", "subroot AS digest", "height", "CAST(array() AS array<struct<left:string,right:string>>) AS path")
    asked = rows.where("doc_id IN (0, 8, 77, 599)").select("tree", "idx", "doc_id")
    got = {r["doc_id"]: [tuple(s) for s in r["path"]][::-1] for r in merkle.descend(graph, starts, asked, []).collect()}
    levels = tree([leaf(r.asDict()) for r in docs.orderBy("doc_id").collect()])
    assert got == {i: up(levels, i) for i in (0, 8, 77, 599)}
