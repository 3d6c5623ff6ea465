"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item of n characters may occur with up to k = floor(rate * n)
edits. Cut into k + 1 pieces, at least one piece of any such occurrence is
unchanged, so all pieces go into one Aho-Corasick automaton, and only places
around exact piece hits are verified, by Myers' bit-parallel edit distance.
Texts are compared with A-Z lower-cased and white space turned into one space.
Items under ``SHORT`` characters must occur without edits, as whole words.

The items are the stated query set: they are taken in blocks of bounded size,
each broadcast to one pass over all documents.

Edge cases: null or empty texts and items match nothing; an item of symbols
alone must stand between white space; repeated documents each get their rows;
repeated items too; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_slices

RATE = 0.08
SHORT = 30
BLOCK_CHARS = 2_000_000
# Scripts written without spaces, whose every character is a word's edge.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\ua4cf\uf900-\ufaff\U00020000-\U0003ffff]")


def plain(raw: bytes) -> str:
    """The compared form of a text: white space to one space, A-Z lower-cased."""
    return b" ".join(raw.lower().split()).decode("utf-8", "replace")


def pieces(item: str, rate: float = RATE) -> list[tuple[int, str]]:
    """(offset, piece) of a cut into one piece more than there may be edits."""
    n = len(item)
    count = int(rate * n) + 1
    edges = [n * i // count for i in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def edits_allowed(item: str, rate: float = RATE) -> int:
    return int(rate * len(item)) if len(item) >= SHORT else 0


def _in_word(c: str) -> bool:
    return c.isalnum() and not UNSPACED.match(c)


def stands_alone(text: str, a: int, b: int) -> bool:
    """Whether ``text[a:b]`` begins and ends where words do; without any letter or
    digit of its own, whether it stands between white space."""
    symbols = not any(c.isalnum() for c in text[a:b])
    for inner, outer in ((text[a], text[a - 1: a]), (text[b - 1], text[b: b + 1])):
        if outer and (outer != " " if symbols else _in_word(inner) and _in_word(outer)):
            return False
    return True


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def best_end(item_masks: dict[str, int], n: int, window: str, free_start: bool = True) -> tuple[int, int]:
    """Myers: least edits of the whole pattern against a substring of ``window``
    (any start if ``free_start``, else its first character), and where it ends."""
    ones, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = ones, 0, n
    best, end = n, 0
    carry = 0 if free_start else 1
    get = item_masks.get
    for j, c in enumerate(window):
        eq = get(c, 0)
        x = eq | down
        d0 = ((((eq & up) + up) ^ up) | x)
        hp = down | (~(d0 | up) & ones)
        hn = d0 & up
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = (hp << 1 | carry) & ones
        hn = (hn << 1) & ones
        up = hn | (~(d0 | hp) & ones)
        down = hp & d0
        if score < best:
            best, end = score, j + 1
    return best, end


class Finder:
    """Searches a block of items (list of (number, compared text))."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE) -> None:
        import ahocorasick

        self.items = {k: t for k, t in items}
        self.budget = {k: edits_allowed(t, rate) for k, t in items}
        self.masks = {k: masks(t) for k, t in items if self.budget[k]}
        self.back = {k: masks(t[::-1]) for k, t in items if self.budget[k]}
        found: dict[str, list[tuple[int, int]]] = {}
        for k, t in items:
            for offset, piece in pieces(t, rate if len(t) >= SHORT else 0):
                found.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in found.items():
            self.automaton.add_word(piece, (len(piece), tuple(owners)))
        if found:
            self.automaton.make_automaton()
        self.any = bool(found)

    def search(self, text: str):
        """Best (item number, edits, start, end) for each item within its budget."""
        if not self.any or not text:
            return []
        starts: dict[int, set[int]] = {}
        for last, (size, owners) in self.automaton.iter(text):
            for k, offset in owners:
                starts.setdefault(k, set()).add(last - size + 1 - offset)
        out = []
        for k, at in starts.items():
            item, budget, best = self.items[k], self.budget[k], None
            n = len(item)
            exact = next((a for a in sorted(at) if a >= 0 and text.startswith(item, a) and (n >= SHORT or stands_alone(text, a, a + n))), None)
            if exact is not None:
                out.append((k, 0, exact, exact + n))
                continue
            if not budget:
                continue
            reached = -1
            for a in sorted(at):
                # Windows of neighbouring starts are verified as one.
                lo, hi = max(0, a - 2 * budget), min(len(text), a + n + 2 * budget)
                if hi <= reached:
                    continue
                if hi - lo < n - budget:
                    continue
                reached = hi
                edits, end = best_end(self.masks[k], n, text[lo:hi])
                if edits <= budget and (best is None or edits < best[0]):
                    best = (edits, lo, lo + end)
            if best is not None:
                edits, lo, end = best
                reverse = text[max(0, end - n - budget):end][::-1]
                _, size = best_end(self.back[k], n, reverse, free_start=False)
                out.append((k, edits, end - size, end))
        return out


def find(docs: DataFrame, items: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, edits, budget, first_char, last_char`` for each document and
    item that it holds; places count characters of the compared form, the last excluded."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = items.schema["item_id"].dataType
    spec = f"doc_id {doc_type}, item_id {item_type.simpleString()}, edits int, budget int, first_char int, last_char int"
    d = docs.select("doc_id", "text")
    items = items.select("item_id", "text").where(F.length("text") > 0)
    # A short item counts as SHORT characters, which bounds the items of a block as well.
    total = items.agg(F.sum(F.greatest(F.length("text"), F.lit(SHORT)))).first()[0] or 0
    count = max(1, -(-total // block_chars))
    out = None
    for b in range(count):
        block = [(r["item_id"], plain(r["text"].encode()))
                 for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b).collect()]
        block = [(i, t) for i, t in block if t]
        sent = d.sparkSession.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            ids = [i for i, _ in sent.value]
            finder = Finder([(k, t) for k, (_, t) in enumerate(sent.value)], rate)
            for batch, texts in arrow_slices(batches):
                keys = batch.column(0)
                rows = [(j, *hit) for j, t in enumerate(texts) for hit in finder.search(plain(t))]
                if rows:
                    at, which, edits, first, last = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(at)), pa.array([ids[k] for k in which], _arrow(item_type)), pa.array(edits, pa.int32()),
                         pa.array([finder.budget[k] for k in which], pa.int32()), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                        ["doc_id", "item_id", "edits", "budget", "first_char", "last_char"])

        hits = d.mapInArrow(run, spec)
        out = hits if out is None else out.unionByName(hits)
    return out


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents that hold no benchmark item, judged by their text alone."""
    keyed = docs.select(F.sha2("text", 256).alias("doc_id"), "text").where("text is not null")
    bad = find(keyed, items, rate).select(F.col("doc_id").alias("__leak")).distinct()
    return docs.withColumn("__text", F.sha2("text", 256)).join(bad, F.col("__text") == F.col("__leak"), "left_anti").drop("__text")
