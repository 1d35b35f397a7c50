"""Pseudonyms: bijection, formats, linking, round trip."""

import random
import re

import pytest

from foliant.llm.pii import KEY, luhn, mask, permute, pii, replace_all, restore

K = KEY.encode()


@pytest.mark.parametrize("size", [1, 2, 7, 100, 1000, 4097])
def test_permutation_is_a_bijection(size):
    out = [permute(i, size, K, b"t") for i in range(size)]
    assert sorted(out) == list(range(size))
    assert [permute(x, size, K, b"t", back=True) for x in out] == list(range(size))


VALUES = {
    "card": ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005"],
    "phone": ["+1 (614) 555-8001", "614-555-8001", "(614) 555-8001", "+49 30 1234567"],
    "email": ["jo.81@mail7.example.com", "JO.81@MAIL7.EXAMPLE.COM", "a_b-c+d@x.org"],
    "ipv4": ["141.73.119.60", "0.0.0.0", "255.255.255.255"],
    "date": ["1999-12-31", "2024/02/29", "31.12.1999", "05/13/2020", "0476-09-04", "2999-01-01"],
    "ssn": ["123-45-6789", "899-99-9999"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "secret": ["04dbebab91ab85687d33eeaaf9ac699e1188f962"],
}


@pytest.mark.parametrize(("kind", "value"), [(k, v) for k, vs in VALUES.items() for v in vs])
def test_formats(kind, value):
    text = f"Before, {value} after. And {value}"
    told, spans = replace_all(text, K)
    assert [s[0] for s in spans] == [kind] * 2
    assert len({s[3] for s in spans}) == 1 and spans[0][3] != value
    assert all(told[s : s + n] == p for _, s, n, p in spans)
    assert value not in told
    assert restore(told) == text
    shape = lambda s: ["9" if c.isdigit() else "a" if c.isalpha() else c for c in s]
    if kind not in ("ipv4", "secret"):
        assert shape(spans[0][3]) == shape(value)
    assert replace_all(text, b"other")[0] != told


def test_valid_stays_valid():
    for value in VALUES["card"]:
        assert luhn("".join(c for c in replace_all(value, K)[0] if c.isdigit())) == 0
    plain, spaced = (replace_all(v, K)[0] for v in VALUES["card"][:2])
    assert plain == spaced.replace(" ", "")
    low, high = (replace_all(v, K)[0] for v in VALUES["email"][:2])
    assert low.upper() == high


@pytest.mark.parametrize("text", [
    "4111111111111112", "256.1.1.1", "1.2.3", "2023-02-29", "Version 2.0.", "CC BY-NC 4.0", "000-12-3456", "a@b", "12345", "", "@",
    "DE00370400440532013000", "99/99/2020",
])
def test_invalid_stays(text):
    assert replace_all(text, K) == (text, [])


@pytest.mark.parametrize(("text", "kinds"), [
    ("+1 (614) 555-8001 4111111111111111", ["phone", "card"]), ("+1 (614) 555-8001 146.47.206.184", ["phone", "ipv4"]),
    ("12 4111111111111111", ["card"]), ("4111111111111112 4111111111111111", ["card"]), ("4111111111111111 123 x", ["card"]), ("1.2.3.4,5.6.7.8", ["ipv4", "ipv4"]),
    ("a.1@x.org b.2@y.org", ["email", "email"]), ('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" 1999-12-31', ["secret", "date"]),
    ("4111111111111111 " * 50, ["card"] * 50), ("JO.81@MAIL7.EXAMPLE.COM!!", ["email"]), ("72@mail3.example.com###", ["email"]),
])
def test_neighbours(text, kinds):
    told, spans = replace_all(text, K)
    assert [s[0] for s in spans] == kinds
    assert restore(told) == text


def test_documents(spark):
    rows = [(1, "mail jo.1@x.org now", "a"), (1, "mail jo.1@x.org now", "a"), (None, None, None), (3, "", "b"), (4, "clean text", "c"),
            (5, "x " * 50_000 + "+1 (614) 555-8001", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = pii(df).collect()
    assert [(r.doc_id, r.n_values, r.kinds) for r in got] == [(1, 1, "email"), (1, 1, "email"), (None, 0, ""), (3, 0, ""), (4, 0, ""), (5, 1, "phone")]
    assert got[0].text == got[1].text != rows[0][1] and got[2].text is None and got[3].text == ""
    assert restore(got[5].text) == rows[5][1]
    told = mask(df)
    assert told.columns == df.columns
    assert [r.spans for r in told.collect()] == [r[2] for r in rows]
    assert pii(df.limit(0)).count() == 0


def plain(text, key):
    """The plain finder: every kind tried at every place, in the order of ``KINDS``."""
    from foliant.llm.pii import KINDS, _card, permute

    turn = lambda value, size, tweak: permute(value, size, key, tweak.encode())
    patterns = [(kind, make, re.compile(p)) for kind, (make, p) in KINDS.items()]
    out, spans, at = "", [], 0
    while at < len(text):
        for kind, make, pattern in patterns:
            m = pattern.match(text, at)
            if not m or kind == "email" and len(re.search(r"(?:[A-Za-z0-9_%+-]+\.)*[A-Za-z0-9_%+-]+$", text[: m.start() + m[0].index("@")])[0]) > 64:
                continue
            told, end = make(m[0], turn), m.end()
            if told is None and kind == "card":
                for cut in [i for i in range(len(m[0]) - 1, 0, -1) if m[0][i] in " -"]:
                    told, end = _card(m[0][:cut], turn), at + cut
                    if told is not None:
                        break
            if told is not None:
                spans.append((kind, len(out), len(told), told))
                out, at = out + told, end
            break
        else:
            told = None
        if told is None:
            out, at = out + text[at], at + 1
    return out, spans


@pytest.mark.parametrize("seed", range(40))
def test_spans_against_a_plain_finder(seed):
    from foliant.llm.pii import replace_all

    rng = random.Random(seed)
    parts = ["a@b.co", "x.y%z+1@mail-1.example.org", "@", ".", "..", "-", "a", "B9", "_", " ", "4111 1111 1111 1111", "4111-1111-1111-1111 22", "+1 (212) 555-0199", "192.168.1.7",
             "2024-02-29", "1/2/1999", "078-05-1120", "DE89 3704 0044 0532 0130 00", "d41d8cd98f00b204e9800998ecf8427e", "1", "00", "=\"", "\"", "a.b.c", "é"]
    for _ in range(60):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert replace_all(text, b"k") == plain(text, b"k"), text


@pytest.mark.parametrize("part", ["a", "7", "a.", "1-", "@", "a@", "a@b.co ", "+1", "aB3", "4111 ", "1.", "2024-", "é@"])
def test_long_runs_take_linear_time(part):
    import time

    from foliant.llm.pii import finder, replace_all

    text, pattern = part * (1_000_000 // len(part)), finder()
    start = time.process_time()
    if part == "a@b.co ":
        text = text[:100_000]
    told, _ = replace_all(text, b"k", pattern)
    assert len(told) == len(text)
    # A second on an idle core; a quadratic search takes hours.
    assert time.process_time() - start < 15


def test_long_names_are_no_addresses():
    from foliant.llm.pii import replace_all

    assert replace_all("a" * 64 + "@b.co", b"k")[1][0][2] == 69
    assert replace_all("a" * 65 + "@b.co", b"k") == ("a" * 65 + "@b.co", [])
