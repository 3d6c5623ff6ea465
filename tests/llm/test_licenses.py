import re

from llm_helpers import make_docs  # noqa: F401
from mentionscope.llm import licenses

BASE = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for label, p in BASE.items() for i in range(len(words))
              if words[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})))


TEXTS = [None, "", "Under the MIT License. under THE mit\nlicense", "the mit license", "CC BY-NC 4.0 cc by nc cc by sa",
         "Licensed under the Apache License, Version 2.0.", "apache license version 20", "éunder the mit license",
         "under the mit licenseé", "cc by cc by nc nc", "mit " * 3000 + "under the mit license",
         "GNU General Public License, version 3.", "under the mit", "license version 2 apache license version 2",
         "Mozilla Public License 1.1", "Mozilla Public License, version 2.0", "x" * 100000]


def test_equal_to_brute_force(make_docs, spark):
    docs = make_docs([(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[2])], extra=["score", "n_words", "places"])
    got = licenses.license_scan(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = TEXTS[r["doc_id"]] if r["doc_id"] is not None else TEXTS[2]
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == brute(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    by = {r["doc_id"]: r for r in got}
    assert by[11]["labels"] == "gpl-3" and by[4]["labels"] == "cc-by-nc,cc-by-sa"
    assert 0 < by[14]["score"] < 1 and by[15]["score"] == 1
    assert licenses.license_scan(make_docs([])).count() == 0


def test_whole_table(spark):
    from mentionscope.llm.catalog import op4_license_scan
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op4_license_scan(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")) == brute(texts[r["doc_id"]])
