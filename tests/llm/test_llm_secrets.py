import hashlib
import random
import re

import corpus
import pytest

from packetloom.llm import secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
PIECES = [
    "password=abcdef1 ", "PASSWORD : 'x'", "token: secret = abcdefgh ", "AKIA" + "A1" * 8 + " ", "AKIASHORT ", "user: bob42 ", "éè😀 ",
    "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY ", "https://api.example.com/x ", "0123456789abcdef01234567", "abcdef", "secret= ",
    "plain words here. ", "x" * 300, "\n",
]


def strong(text):
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def spans(found):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in found)


def overlap(a, b):
    return a[0] < b[2] and b[0] < a[2]


def linked(text):
    """Every weak part against every other part."""
    base = strong(text)
    mixed = [(m.start(), 3, m.end(), "secret") for m in re.finditer(secrets.MIXED, text) if all(re.search(c, m[0]) for c in ("[0-9]", "[a-z]", "[A-Z]"))]
    mixed = [m for m in mixed if not any(overlap(m, b) for b in base)]
    account = [(m.start(), 5, m.end(), "") for m in re.finditer(secrets.ACCOUNT, text)]
    endpoint = [(m.start(), 4, m.end(), "endpoint") for m in re.finditer(secrets.ENDPOINT, text)]
    wide = lambda s: (s[0] - secrets.REACH, s[1], s[2] + secrets.REACH)
    weak = [m for m in mixed if any(overlap(wide(m), o) for o in [b for b in base if b[3] == "access"] + account)]
    ends = [e for e in endpoint if any(overlap(wide(e), m) for m in weak)]
    return sorted(base + weak + ends)


def texts():
    pick = random.Random(5)
    return ["".join(pick.choices(PIECES, k=pick.randint(1, 9))) for _ in range(250)] + ["token=abcdefg " * 2000]


def test_equals_brute_force(spark):
    docs = corpus.awkward(spark, texts())
    rows = secrets.secret_report(docs).collect()
    expected = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert len(rows) == len(expected)
    by_row = sorted((str(i), len(strong(t)), hashlib.sha256(spans(strong(t)).encode()).hexdigest(), spans(linked(t))) for i, t in expected)
    assert sorted((str(r.doc_id), r.n_assign + r.n_access + r.n_hex, r.base_sha256, r.spans) for r in rows) == by_row
    assert any("secret:" in r.spans for r in rows) and any("endpoint:" in r.spans for r in rows)


def test_a_weak_part_alone_is_not_reported(spark):
    weak = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY"
    docs = spark.createDataFrame([(1, f"see {weak} now"), (2, f"user=alice {weak}"), (3, f"user=alice {'.' * 300} {weak}")], "doc_id long, text string")
    found = {r.doc_id: r.spans for r in secrets.secret_report(docs).collect()}
    assert found[1] == "" and found[3] == "" and found[2].startswith("secret:")


def test_redaction_keeps_columns_and_other_texts(spark):
    docs = corpus.awkward(spark, ["a password=abcdef1, b", "nothing here"], repeat=False)
    done = {r.doc_id: r for r in secrets.redacted(docs).collect()}
    assert secrets.redacted(docs).columns == docs.columns
    assert done[0].text == "a [SECRET], b" and done[1].text == "nothing here" and done[9001].text is None and done[0]["_text"] == 5


def test_native_and_empty(spark):
    docs = corpus.awkward(spark, texts()[:20])
    assert secrets.secret_report(corpus.empty(docs)).count() == 0
    plan = secrets.secret_report(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian", plan)


@pytest.mark.parametrize("pattern", [secrets.ASSIGN, secrets.ACCESS, secrets.HEX, secrets.ACCOUNT, secrets.MIXED])
def test_patterns_mean_the_same_in_both_languages(spark, pattern):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(t,) for t in texts()], "t string").select("t", F.regexp_extract_all("t", F.lit(pattern), F.lit(0)).alias("m"))
    for r in rows.collect():
        assert r.m == [m[0] for m in re.finditer(pattern, r.t, re.ASCII)]


def complete(text):
    """As ``linked``, where assigned values and hex are secrets, too, and accounts are reported."""
    base = strong(text)
    mixed = [(m.start(), 3, m.end(), "secret") for m in re.finditer(secrets.MIXED, text) if all(re.search(c, m[0]) for c in ("[0-9]", "[a-z]", "[A-Z]"))]
    mixed = [m for m in mixed if not any(overlap(m, b) for b in base)]
    account = [(m.start(), 5, m.end(), "account") for m in re.finditer(secrets.ACCOUNT, text)]
    endpoint = [(m.start(), 4, m.end(), "endpoint") for m in re.finditer(secrets.ENDPOINT, text)]
    wide = lambda s: (s[0] - secrets.REACH, s[1], s[2] + secrets.REACH)
    near = lambda a, others: any(overlap(wide(a), o) for o in others)
    parts = mixed + [b for b in base if b[3] != "access"]
    known = [s for s in parts if near(s, [b for b in base if b[3] == "access"] + account)]
    return sorted(base + [s for s in known if s[3] == "secret"] + [e for e in endpoint if near(e, known)] + [a for a in account if near(a, parts)])


def test_strong_secrets_link_endpoints_and_accounts(spark):
    given = ["user=bob password=hunter22 host=db.example.com", "AKIA" + "A1" * 8 + " token=Abc123xyz https://host/x", "user=bob host=db.example.com"]
    docs = spark.createDataFrame(list(enumerate(given + texts())), "doc_id long, text string")
    rows = {r.doc_id: r for r in secrets.secret_report(docs, complete=True).collect()}
    for r in docs.collect():
        assert rows[r.doc_id].spans == spans(complete(r.text))
        assert rows[r.doc_id].base_sha256 == hashlib.sha256(spans(strong(r.text)).encode()).hexdigest()
    assert rows[0].spans == "account:0:8,assign:9:26,endpoint:27:46" and "endpoint:" in rows[1].spans and rows[2].spans == ""
    done = {r.doc_id: r.text for r in secrets.redacted(docs, complete=True).collect()}
    assert done[0] == "[SECRET] [SECRET] [SECRET]" and done[2] == given[2]
