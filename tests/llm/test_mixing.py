import math
import re

from llm_helpers import collect, make_docs  # noqa: F401
from mentionscope.llm import mixing


def water_level(sizes, weights=(3, 1, 2)):
    """Share, stop at the cap, share the excess again until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = 1.5 * sum(sizes.values())
    out, left, free = {}, total, set(sizes)
    while free:
        each = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if each[s] > 2 * sizes[s]}
        if not above:
            return out | each
        for s in above:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= above
    return out


def test_targets_copies_and_reruns(make_docs):
    rows = [(i, "w " * (1 + i * 7 % 50), "en", ["a", "b", "c", "é", None][0 if i % 3 else i % 5]) for i in range(900)]
    df = make_docs(rows)
    got = mixing.mix(df).collect()
    assert len(got) == 900
    size = {}
    for r in got:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        assert r["size"] == n and r["taken"] == r["copies"] * n and 0 <= r["copies"] <= 2
        size[r["source"]] = size.get(r["source"], 0) + n
    want = water_level(size)
    taken = {}
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in size:
        assert abs(taken[s] - want[s]) <= 0.05 * want[s] + 100
    again = mixing.mix(df.repartition(7))
    assert collect(again, "doc_id", "copies") == sorted(((r["doc_id"], r["copies"]) for r in got), key=repr)
    assert mixing.repeated(again).count() == sum(r["copies"] for r in got)


def test_edges(make_docs):
    rows = [(1, None, "en", "a"), (2, "", "en", None), (None, "x y", None, None), (3, "x", "en", "b"), (3, "x", "en", "b"),
            (4, "v" * 200000 + " " + "w " * 30000, "en", "a")]
    df = make_docs(rows, extra=["size", "target", "copies"])
    got = mixing.mix(df).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in got) == [(0, 2), (1, 0), (2, 0), (3, 1), (3, 1), (4, 30001)]
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.mix(make_docs([])).count() == 0
    assert all(r["target"] == 0 and r["copies"] == 0 for r in mixing.mix(make_docs([(1, None), (2, "")])).collect())
