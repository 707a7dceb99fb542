"""Operator 9: precision and recall on a labelled set, base patterns by a plain scan, the bound of the sample."""

from __future__ import annotations

import random
import re

import pytest

from footfall.llm import common, secrets

WORDS = (
    "abstract singleton proxy factory bean configuration manager customer session resource documentation request "
    "handler service provider response controller repository transaction validator listener adapter context builder "
    "exception serializer template registry scheduler executor pipeline dispatcher encoder buffer connection timeout"
).split()
ORDINARY = [
    "AbstractSingletonProxyFactoryBeanConfigurationManager",
    "x" * 60,
    "12345678901234567890123456789012",
    "Llanfairpwllgwyngyllgogerychwyrndrobwllllantysiliogogogoch",
    "Konstantynopolitanczykowianeczka",
    "Donaudampfschifffahrtsgesellschaftskapitaen",
    "lentokonesuihkuturbiinimoottoriapumekaanikkoaliupseerioppilas",
    "=" * 30,
    "/usr/local/lib/python3/site-packages/numpy/core",
    "https/www/example/com/index/html/2024/01/31",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "btn-primary-lg-col-md-6-offset-md-3",
    "test_user_1234567890_backup_2024",
]


@pytest.fixture(scope="module")
def model(spark):
    return secrets.fit(secrets.labelled_samples(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))


def test_precision_and_recall(model):
    own = random.Random(1)
    ordinary = list(ORDINARY)
    while len(ordinary) < 900:
        some = [own.choice(WORDS) for _ in range(own.randint(3, 6))]
        way = own.randrange(5)
        made = ["".join(w.title() for w in some), some[0] + "".join(w.title() for w in some[1:]), "_".join(some), "-".join(some), "_".join(some).upper()][way]
        if len(made) >= secrets.LEAST_CHARS:
            ordinary.append(made)
    letters = secrets._ALPHABET
    random_ones = ["".join(own.choice(letters[: own.choice((62, 64))]) for _ in range(own.choice((24, 32, 40)))) for _ in range(900)]
    glued = ["/".join([*own.choices(WORDS, k=own.randint(1, 6)), s]) for s in random_ones[:400]]
    alarms = [t for t in ordinary if secrets.random_parts(t, model)]
    found = [t for t in random_ones + glued if secrets.random_parts(t, model)]
    assert not set(alarms) & set(ORDINARY)
    assert len(found) / (len(random_ones) + len(glued)) >= 0.97
    assert len(found) / (len(found) + len(alarms)) >= 0.97


def plain_base(text):
    found = {k: [] for k in secrets.KINDS}
    for kind, least in (("access", 18), ("hex", 16)):
        inside = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" if kind == "access" else "0123456789abcdef"
        at = 0
        while at < len(text):
            ahead = 4 if kind == "access" else 0
            if ahead and text[at : at + 4] != "AKIA":
                at += 1
                continue
            end = at + ahead
            while end < len(text) and text[end] in inside:
                end += 1
            if end - at < ahead + 1:
                at += 1
                continue
            if end - at >= least:
                found[kind].append((kind, at, end))
            at = max(end, at + 1)
    return found


def test_base_kinds_equal_a_plain_scan():
    own = random.Random(5)
    for _ in range(3000):
        text = "".join(own.choice(("AKIA", "A", "K", "0", "f", "9", "z", " ", "é", "0123456789abcdef")) for _ in range(own.randint(0, 25)))
        got, want = secrets.base_spans(text), plain_base(text)
        assert got["access"] == want["access"] and got["hex"] == want["hex"]
        names = "password|passwd|secret|token|api_?key"
        text = "".join(own.choice(("PassWord", "token", "api_key", "APIKEY", "secret", " ", "=", ":", '"', "'", "x", "a.b-", "/9+")) for _ in range(own.randint(0, 18)))
        plain = [
            ("assign", m.start(), m.end())
            for m in re.finditer(rf"({names})[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)", text, re.IGNORECASE | re.ASCII)
            if len(m.group(2)) >= 12
        ]
        assert secrets.base_spans(text)["assign"] == plain


def test_an_id_does_not_lift_the_bound(spark):
    rows = [(1, f"text number {i}", "x") for i in range(300)] + [(2, "same", "y")] * 300 + [(None, "z", "x"), (3, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash string")
    assert common.bounded_sample(docs, 50).count() == 50
    assert common.bounded_sample(docs, 1000).count() == 301
