import re

from orograd.llm import pseudonyms as P

KEY = b"test key"
TEXT = ("card 4041894974608795 or 4041-8949-7460-8795, mail Bosbt.42@mail8.example.com, ip 42.144.35.254, tel +1 (988) 555-2485, 2020-02-29, 02/29/2020, on March 3, 1999, "
        "ssn 123-45-6789, iban DE89 3704 0044 0532 0130 00, version 4.0. and 1234567890123456 and 2020-13-45 and 999.1.1.1")


def test_permutation_and_inverse():
    for size in (1, 2, 3, 10, 97, 1000):
        out = [P.permute(KEY, "t", v, size) for v in range(size)]
        assert sorted(out) == list(range(size)) and [P.unpermute(KEY, "t", v, size) for v in out] == list(range(size))
    assert P.permute(KEY, "t", 10 ** 30 - 1, 10 ** 30) < 10 ** 30


def test_formats_stay_valid_and_values_linked():
    found = {m.lastgroup: m[0] for m in P.matches(TEXT) if P.valid(m.lastgroup, m[0])}
    assert set(found) == set(P.KINDS)
    for kind, value in found.items():
        new = P.pseudonym(KEY, kind, value)
        shape = lambda s: re.sub(r"[A-Za-z]+", "a", re.sub(r"\d+", "9", s)) if kind in ("ip", "date") else re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "9", s)))
        assert P.valid(kind, new) and shape(new) == shape(value) and new == P.pseudonym(KEY, kind, value), (kind, new)
    a, b = P.pseudonym(KEY, "card", "4041894974608795"), P.pseudonym(KEY, "card", "4041-8949-7460-8795")
    assert b.replace("-", "") == a != P.pseudonym(b"other", "card", "4041894974608795")
    days = {P.pseudonym(KEY, "date", x) for x in ("2020-02-29", "02/29/2020")}
    assert len({tuple(sorted(re.findall(r"\d+", x))) for x in days}) == 1
    made = {P.pseudonym(KEY, "phone", f"+1 (988) 555-{k:04d}") for k in range(2000)}
    assert len(made) == 2000


def test_places_lose_no_match():
    for text in (TEXT, TEXT * 3, "x" * 50_000 + TEXT, "1" * 5000, "a@b", "", "no digits", "+1 (988) 555-2485\n+1 (988) 555-2485"):
        assert [m.span() for m in P.matches(text)] == [m.span() for m in P.ANY.finditer(text)]


def test_table(spark):
    rows = [(1, TEXT, "f"), (2, TEXT, None), (3, None, None), (4, "", "x"), (None, "plain", "x"), (1, TEXT, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, swapped string")
    out = P.pseudonymise(df, KEY).collect()
    texts = {r["text"] for r in out if r["doc_id"] in (1, 2)}
    assert len(out) == 6 and len(texts) == 1 and df.columns == [c for c in out[0].asDict() if c != "found"]
    new = texts.pop()
    assert "4041894974608795" not in new and "@mail8.example.com" not in new and "1234567890123456" in new and "999.1.1.1" in new
    assert out[0]["found"]["card"] == 2 and {r["text"] for r in out if r["doc_id"] in (3, 4, None)} == {None, "", "plain"}
    assert P.pseudonymise(df.where("false"), KEY).count() == 0


def test_values_beside_other_words_and_digits(spark):
    card, spaced, iban, be = "4111111111111111", "4111 1111 1111 1111", "ES9121000418450200051332", "BE68 5390 0754 7034"
    cases = {f"{spaced} 12/27": (spaced, "card"), f"12 {spaced}": (spaced, "card"), f"{card} 3": (card, "card"), f"1234 {spaced} 1234": (spaced, "card"),
             "4111-1111-1111-1111-12": ("4111-1111-1111-1111", "card"), f"{iban} EUR": (iban, "iban"), f"{be} BIC": (be, "iban"), f"AB12 {be} BIC CODE": (be, "iban"),
             f"+1 {spaced}": (spaced, "card"), f"000-12-3456 {spaced}": (spaced, "card"), "PL61109010140000071219812874 PLN": ("PL61109010140000071219812874", "iban")}
    for text, (value, kind) in cases.items():
        assert (value, kind) in [(text[a:b], k) for a, b, k in P.values(text)], text
    both = f"{spaced} 12 bob@example.com 123-45-6789 {iban} EUR 2020-02-29"
    assert [k for _, _, k in P.values(both)] == ["card", "email", "ssn", "iban", "date"]
    assert list(P.values("1234567890123456 and 2020-13-45 and 999.1.1.1 ES9121000418450200051333 EUR")) == []
    out = P.pseudonymise(spark.createDataFrame([(both,)], "text string"), KEY, id_col="text").first()
    assert out["found"] == {"card": 1, "email": 1, "ssn": 1, "iban": 1, "date": 1} and not any(x in out["text"] for x in (spaced, iban, "bob@", "123-45-6789"))
    long = "1 2 3 " * 20_000
    assert all(P.valid(k, long[a:b]) for a, b, k in P.values(long))


def test_values_take_all_valid_matches():
    for text in (TEXT, TEXT * 3, "x" * 5000 + TEXT):
        assert [(*m.span(), m.lastgroup) for m in P.matches(text) if P.valid(m.lastgroup, m[0])] == list(P.values(text))
