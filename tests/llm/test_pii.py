"""Base spans by plain regular expressions, votes, estimation and classifier on made-up data."""

from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from stratalith.llm import pii
from stratalith.llm.pii import KINDS, Span


def plain_base(text):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(x) for x in digits(m)][::-1]
        if 14 <= len(d) <= 19 and (sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])) % 10 == 0:
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m)) <= 15]
    return sorted(((k, m.start(), m.end()) for k, m in out), key=lambda s: (s[1], KINDS.index(s[0])))


ODD = [
    "", "a@b", "a@b.c", "x@y.z@w.v", "a@b..c d@e.f.", "@a.b", "a@@b.c", "é@b.c ü.x@y-z.de", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.0255 00000000000000255.1.1.1", "1..2.3.4", "4111 1111 1111 1111",
    "4111-1111-1111-1111 4111  1111", "41111111111111112222", "0000 0000 0000 00", "+1 (017) 555-7713", "+1 (2", "++49 30 1234567", "+12 345 678 901 234 567", "+1-1-1 +49.30.123456", "a@1.2.3.4 +1 2.3.4.5",
    "５５５ ١٢٣", "+4111 1111 1111 1111",
]


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("0123456789 .-+@()ab") for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["".join(rng.choice("14 .-@+a") for _ in range(40)) for _ in range(2000)]
    for text in texts:
        assert [tuple(s) for s in pii.base_spans(text)] == plain_base(text), repr(text)


def test_long_runs_take_linear_time():
    began = time.process_time()
    for text in ("a" * 10**6, "a@" * 3 * 10**5, "1" * 10**6, "1." * 3 * 10**5, "+1" + "(" * 10**6, "1 " * 10**6, "a" * 10**6 + "@", "1:" * 10**5, "(12) " * 10**5):
        pii.candidates(text)
    assert time.process_time() - began < 60


def test_reliable_labelers_are_told_from_noise():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.4
    good, fair, noise = (np.where(rng.random(4000) < p, truth, ~truth) for p in (0.95, 0.8, 0.5))
    votes = np.stack([2 * x.astype(int) - 1 for x in (good, fair, noise, np.where(rng.random(4000) < 0.9, truth, ~truth))], axis=1)
    posterior, tables = pii.estimate(votes, np.ones(4000))
    right = tables[:, 1, 2]
    assert right[0] > 0.85 > right[1] > 0.7 > right[2] and ((posterior > 0.5) == truth).mean() > 0.93


TEXTS = [f"Please write by mail to person{k}@site{k % 7}.com today" for k in range(40)] + [f"call the phone +1 (212) 555-{1000 + k} now" for k in range(40)]
TEXTS += [f"plain words without anything number {k}" for k in range(40)] + [f"host 192.168.{k}.7 and card 4111 1111 1111 1111" for k in range(20)]
HIDDEN = "mail jane (at) site3 (dot) com or call phone (212) 555-4321"


def test_rows_and_added_spans(spark):
    rows = list(enumerate(TEXTS)) + [(900, None), (901, HIDDEN), (None, "a@b.com"), (0, TEXTS[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({"spans": F.lit("clash"), "kind": F.lit(1), "n_chars": F.length("text")})
    classifier = pii.learn(docs)
    found = pii.personal_data(docs, classifier).collect()
    assert len(found) == len(rows)
    for r in found:
        text = dict(rows)[r.doc_id] or ""
        base = plain_base(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and r.base_spans == joined
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in base) for k in KINDS]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
        if "plain words" in text:
            assert r.spans == ""
    hidden = next(r.spans for r in found if r.doc_id == 901)
    assert hidden == f"email:5:{HIDDEN.index(' or')},phone:{HIDDEN.index('(212')}:{len(HIDDEN)}"
    clean = {r.doc_id: r for r in pii.without_personal_data(docs, classifier, length_col="n_chars").collect()}
    assert clean[901].text == "mail [EMAIL] or call phone [PHONE]" and clean[901].n_chars == len(clean[901].text)
    assert clean[900].text is None and clean[100].text == TEXTS[100]
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_neighbours_that_hide_base_spans():
    """The base phone and card patterns run on into numbers that follow; the wider ones stop in time."""
    classifier = pii.trained([(c.span.kind, c.votes, c.shape, 1) for t in TEXTS for c in pii.candidates(t)])
    for text, spans in (
        ("at +1 (826) 555-4081 190.137.2.9 x", [("phone", 3, 20), ("ip", 21, 32)]),
        ("at 4111111111111111 190.137.2.9 x", [("card", 3, 19), ("ip", 20, 31)]),
        ("at 4111111111111112 190.137.2.9 x", [("ip", 20, 31)]),
    ):
        assert [tuple(s) for s in pii.spans_of(text, classifier)[1]] == spans, text


def test_compressed_addresses_and_national_numbers():
    texts = TEXTS + ["host 2001:db8::1 is up", "call the phone 0171 234 5678 now"]
    classifier = pii.trained([(c.span.kind, c.votes, c.shape, 1) for t in texts for c in pii.candidates(t)])
    found = lambda t: [(s.kind, t[s.start : s.end]) for s in pii.spans_of(t, classifier)[1]]
    for address in ("2001:db8::1", "fe80::1:2", "2001:db8:0:1:1:1:1:1", "2001:DB8:1::ab9:C0A8:102"):
        assert found(f"host {address} is up") == [("ip", address)], address
    for other in ("1:2:3:4:5:6::1:2:3", "face::bed", "12::30"):
        assert found(f"host {other} is up") == [], other
    for number in ("0171 234 5678", "030/1234 5678", "01 42 68 53 00"):
        assert found(f"call the phone {number} now") == [("phone", number)], number
    assert found("on 01.02.2003 12:30 and 2020-01-02") == []


def test_replacement_of_spans_that_overlap():
    assert pii.replaced("0123456789", [Span("ip", 1, 4), Span("phone", 3, 6), Span("card", 8, 9)]) == "0[IP]67[CARD]9"


def luhn_number(rng, prefix, n):
    digits = prefix + "".join(str(rng.randrange(10)) for _ in range(n - len(prefix) - 1))
    return next(digits + d for d in "0123456789" if pii.luhn(digits + d))


def planted(seed, n=400):
    """Texts with personal data in forms beyond the base, with what only looks like it, and with base forms; and what is to be found."""
    rng = random.Random(seed)
    two = lambda: f"{rng.randrange(10, 99)}"
    four = lambda: f"{rng.randrange(2000, 9999)}"

    def card():
        d = luhn_number(rng, rng.choice(("4", "51", "55")), 16)
        return rng.choice("._/").join(d[k : k + 4] for k in range(0, 16, 4))

    def wrong():
        d = rng.choice("46") + "".join(str(rng.randrange(10)) for _ in range(15))
        return d if not pii.luhn(d) else d[:-1] + str((int(d[-1]) + 1) % 10)

    good = {
        "email": [lambda: f"jane{two()} [at] site{two()} [dot] com", lambda: f"bob.{two()}(at)firm.org", lambda: f"eva_{two()} {{at}} post dot de"],
        "ip": [lambda: f"10[.]{two()}[.]{two()}[.]7", lambda: f"2001:db8::{two()}", lambda: f"fe80::{two()}:9"],
        "card": [card],
        "phone": [lambda: f"(0{two()}) {two()}3 {four()}", lambda: f"0171 {two()}4 {four()}", lambda: f"2{two()}-5{two()}-{four()}", lambda: f"0044 20 {four()} {four()}"],
    }
    bad = [lambda: f"20{two()}-01-{two()}", lambda: f"01.02.{four()}", lambda: f"{two()}.{two()}.{two()}", wrong, lambda: f"{two()}-{two()}", lambda: f"face::{two()}", lambda: f"12.{two()}",
           lambda: f"9[.]999[.]{two()}[.]{two()}", lambda: f"{four()} {four()}", lambda: f"me at home dot"]
    base = [lambda: f"mail a{two()}@site.com", lambda: f"host 192.168.{two()}.9", lambda: f"card {luhn_number(rng, '4', 16)}", lambda: f"phone +1 (212) 555-{four()}"]
    cue = {"email": "mail", "ip": "host", "card": "card", "phone": "call"}
    made = []
    for _ in range(n):
        text, wanted = "", set()
        for _ in range(4):
            what = rng.random()
            if what < 0.3:
                kind = rng.choice(KINDS)
                text += rng.choice((cue[kind], "see")) + " "
                span = rng.choice(good[kind])()
                wanted.add((kind, len(text), len(text) + len(span)))
                text += span + " then "
            elif what < 0.65:
                text += rng.choice(("order", "on", "version", "page")) + " " + rng.choice(bad)() + " then "
            else:
                text += rng.choice(base)() + " then "
        made.append((text, wanted))
    return made


def added(made, classifier):
    out = []
    for text, _ in made:
        base, every = pii.spans_of(text, classifier)
        out.append({tuple(s) for s in every} - {tuple(s) for s in base})
    return out


def test_precision_and_recall_of_added_spans():
    made = planted(7)
    patterns = [(c.span.kind, c.votes, c.shape, 1) for text, _ in made for c in pii.candidates(text)]
    found = added(made, pii.trained(patterns))
    for kind in KINDS:
        right = sum(len({s for s in a & w if s[0] == kind}) for a, (_, w) in zip(found, made))
        assert right >= 0.9 * sum(s[0] == kind for a in found for s in a), kind
        assert right >= 0.9 * sum(s[0] == kind for _, w in made for s in w), kind
    # What is not estimated from the agreement of the votes is decided otherwise.
    assert added(made, pii.trained(patterns, rounds=0)) != found


def test_the_probability_alone_decides():
    """Where cards fail their checksum as often as not, it no longer speaks against them."""
    rng = random.Random(2)
    texts = [f"credit card {rng.choice('45')}{''.join(str(rng.randrange(10)) for _ in range(14))} then" for _ in range(50)]
    numbers = [f"credit card 4{''.join(str(rng.randrange(10)) for _ in range(3))}.1234.5678.{rng.randrange(1000, 9999)} then" for _ in range(300)]
    trained = pii.trained([(c.span.kind, c.votes, c.shape, 1) for t in texts + numbers for c in pii.candidates(t)])
    failed = [c for t in numbers for c in pii.candidates(t) if c.votes[3] < 0]
    assert failed and all(trained.probability("card", c.votes, c.shape) >= pii.LEAST for c in failed)
    usual = pii.trained([(c.span.kind, c.votes, c.shape, 1) for t, _ in planted(3) for c in pii.candidates(t)])
    assert all(usual.probability("card", c.votes, c.shape) < pii.LEAST for c in failed)
