import hashlib
import random
import re

from quill.llm.pii import BASE, automaton, find, iban_holds, luhn, personal_data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                  "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], BASE.index(x[0])))


def check(texts):
    anchors = automaton()
    for t in texts:
        assert [x for x in find(t, anchors) if x[0] in BASE] == brute(t), repr(t)


def test_base_kinds_equal_regular_expressions(spark, sf_small):
    r = random.Random(7)
    soup = list("0123456789012345678901.-+@ ()aZ_%é中:/\n") + ["a@b.c", "1.2.3.4", "255.", "+1 (017) 555-7713",
                                                               "4111 1111 1111 1111", "@@", "..", "1-1", "Token = ",
                                                               "http://", "10.0.0.256", "000001.2.3.4"]
    check("".join(r.choice(soup) for _ in range(r.randrange(1, 40))) for _ in range(30_000))
    check(x["text"] for x in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect())
    check([None, "", "4" * 5000, "1." * 3000 + "1", "a" * 100_000 + "@" + "b." * 10 + "c", "+1" + "-" * 10_000,
           "@" * 5000])


def spans(text):
    return [(k, text[s:e]) for k, s, e in find(text, automaton())]


def test_added_kinds():
    assert spans('api token = "04dbebab91ab85687d33ee" end') == [("secret", "04dbebab91ab85687d33ee")]
    assert spans("see https://www.example.com/a?b=c now") == [("url", "https://www.example.com/a?b=c")]
    assert spans("IBAN: DE89 3704 0044 0532 0130 00 thanks") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert spans("IBAN: DE89 3704 0044 0532 0130 01 thanks") == []
    assert spans("account no. 12345678") == [("account", "12345678")]
    assert spans("lives at 12 Long River Street since") == [("address", "12 Long River Street")]
    assert spans("Hauptstraße 5 in") == [("address", "Hauptstraße 5")]
    assert spans("12 rue de Lyon") == [("address", "12 rue de Lyon")]
    assert spans("Calle Mayor 7") == [("address", "Calle Mayor 7")]
    # base spans stay, added ones do not lie on them
    assert spans("password: joe1234@example.com") == [("email", "joe1234@example.com")]
    assert spans("a token of thanks, the street, no account of it") == []


def test_checks():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert iban_holds("GB82WEST12345698765432") and not iban_holds("GB82WEST12345698765433")


def test_nasty(spark, nasty):
    empty = hashlib.sha256(b"").hexdigest()
    rows = personal_data(nasty).collect()
    assert len(rows) == nasty.count()
    assert all(r["base_sha256"] == empty and r["spans"] == "" for r in rows if r["doc_id"] in (1, 2, 3, 4, None))
    assert personal_data(nasty.limit(0)).collect() == []
    one = spark.createDataFrame([(1, "é x@y.zz 1.2.3.4")], "doc_id long, text string")
    r = personal_data(one).first()
    assert r["spans"] == "email:2:8,ip:9:16" and (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 0, 0)
    assert r["base_sha256"] == hashlib.sha256(b"email:2:8,ip:9:16").hexdigest()
