import datetime
import re

from llm_helpers import make_docs  # noqa: F401
from mentionscope.llm import pii


def luhn(s):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(s)))) % 10 == 0


def iban_ok(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def run(make_docs, texts):
    got = pii.pseudonymise(make_docs(list(enumerate(texts))), pii.OPEN_KEY).collect()
    return {r["doc_id"]: r for r in got}


def test_kinds_and_formats(make_docs):
    texts = ["card 4417 7442 8035 1547 and 4417744280351547 end", "bad 2390409500648960 stays",
             "mail errest.23@mail3.example.com, x", "ip 152.143.123.131 and 300.1.1.1 and 1.2.3.4.5",
             "call +1 (017) 555-7713 now", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"###',
             "born 1987-02-28 or 28/02/1987 or 02.30.1999 x 1999-02-30", "ssn 123-45-6789 and 666-45-6789",
             "iban DE89 3704 0044 0532 0130 00 and DE89370400440532013000 and DE00370400440532013000",
             "7536784127813050 4845168114407329", 'TOKEN = "9999A9ECF9C9B99FE9999999B9B99BC999E9999B"!!', "plain words 12 4.0, v2.0.1"]
    got = run(make_docs, texts)
    a, b = re.findall(r"\d[\d ]{14,}\d", got[0]["text"])
    assert a.replace(" ", "") == b and luhn(b) and b != "4417744280351547" and len(a) == 19
    assert got[1]["text"] == texts[1] and got[11]["text"] == texts[11] and not got[11]["pii"]
    assert re.fullmatch(r"mail user[0-9a-f]{12}@example\.invalid, x", got[2]["text"])
    assert "152.143.123.131" not in got[3]["text"] and got[3]["text"].endswith("300.1.1.1 and 1.2.3.4.5")
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} now", got[4]["text"]) and got[4]["text"] != texts[4]
    assert re.fullmatch(r'token = "[0-9a-f]{40}"###', got[5]["text"]) and got[5]["text"] != texts[5]
    iso, slash = re.search(r"born (\S+) or (\S+)", got[6]["text"]).groups()
    assert datetime.date.fromisoformat(iso).strftime("%d/%m/%Y") == slash and iso != "1987-02-28"
    assert got[6]["text"].endswith("or 02.30.1999 x 1999-02-30")
    assert "123-45-6789" not in got[7]["text"] and "666-45-6789" in got[7]["text"]
    ibans = re.findall(r"DE\d\d(?: ?\d{4}){4} ?\d\d", got[8]["text"])
    assert iban_ok(ibans[0]) and ibans[0].replace(" ", "") == ibans[1] != "DE89370400440532013000" and ibans[2] == "DE00370400440532013000"
    for i in (9, 10):
        assert len(got[i]["text"]) == len(texts[i])
    assert got[10]["text"] != texts[10]
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_edges(make_docs):
    docs = make_docs([(1, None), (2, ""), (None, "1.2.3.4"), (3, "1.2.3.4"), (3, "1.2.3.4"), (4, "9" * 100000 + "a." * 50000 + " 1.2.3.4")],
                     extra=["pii", "key", "kind"])
    got = pii.pseudonymise(docs, pii.OPEN_KEY).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["text"])
    assert by[1] == [None] and by[2] == [""] and by[3][0] == by[3][1] == by[None][0] != "1.2.3.4"
    assert by[4][0].endswith(by[3][0]) and len(got) == 6 and got[0]["key"] == "own"
    assert pii.pseudonymise(make_docs([]), pii.OPEN_KEY).count() == 0


def test_permutations_are_one_to_one(spark):
    from pyspark.sql import functions as F
    ids = spark.range(73049)
    days = ids.select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("v"))
    out = days.select(pii._date("k", F.col("v")).alias("o"))
    assert out.distinct().count() == 73049 and out.where("o is null").count() == 0
    codes = spark.range(100000).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("v"))
    assert codes.select(pii.permute_digits("k", F.lit("x"), F.col("v")).alias("o")).distinct().count() == 100000
    cards = spark.range(5000).select(F.lpad((F.col("id") * 7919 + 4000000000000).cast("string"), 15, "4").alias("b"))
    cards = cards.select(F.concat("b", pii.luhn_digit(F.col("b"))).alias("v")).select(pii._card("k", F.col("v")).alias("o")).collect()
    assert len({r["o"] for r in cards}) == 5000 and all(luhn(r["o"]) for r in cards)


def test_ibans_end_where_their_country_says(make_docs):
    """A word behind the number is no part of it, nor keeps it from being replaced."""
    texts = ["IBAN BE68 5390 0754 7034 BIC KREDBEBB", "ES91 2100 0418 4502 0005 1332 BIC CAIXESBB", "BE68539007547034 ABCD", "NO93 8601 1117 947 und mehr",
             "BE68 5390 0754 7035 BIC KREDBEBB", "MT84 MALT 0110 0001 2345 MTLC AST0 01S XYZ"]
    got = run(make_docs, texts)
    for i, tail in ((0, " BIC KREDBEBB"), (1, " BIC CAIXESBB"), (2, " ABCD"), (3, " und mehr"), (5, " XYZ")):
        new = got[i]["text"]
        assert new.endswith(tail) and new != texts[i] and [p["kind"] for p in got[i]["pii"]] == ["iban"]
        number = new[:-len(tail)].removeprefix("IBAN ")
        assert iban_ok(number) and [c == " " for c in number] == [c == " " for c in texts[i][:-len(tail)].removeprefix("IBAN ")]
    assert got[4]["text"] == texts[4]                                # its check digits are wrong
    a, b = got[0]["text"][5:24].replace(" ", ""), got[2]["text"][:16]
    assert a == b                                                    # one account, one pseudonym


def test_another_key_gives_other_pseudonyms(make_docs):
    docs = make_docs([(1, "card 4417744280351547")])
    assert pii.pseudonymise(docs, "x").first()["text"] != pii.pseudonymise(docs, "y").first()["text"]
