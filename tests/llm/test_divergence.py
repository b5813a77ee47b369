"""The audit of sources against a plain version."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from seawarden.llm import divergence
from tests.llm.conftest import ODD, row

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOW = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def plain(rows, least=30):
    counts, holders = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        terms = TERM.findall((text or "").translate(LOW))
        counts[lang or "", source or ""].update(terms)
        holders[lang or ""].update(set(terms))
    out = []
    for lang in holders:
        kept = {t for t, n in holders[lang].items() if n >= least}
        groups = {source: c for (other, source), c in counts.items() if other == lang}
        whole = sum(groups.values(), Counter())

        def shares(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        p, q = {source: shares(c) for source, c in groups.items()}, shares(whole)
        for source in groups:
            pairs = [(-sum(abs(p[source][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != source]
            above = [(q[t] - p[source][t], t.encode()) for t in kept if groups[source][t] and p[source][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(above)[:50])):
                out += [(lang, source, part, i.decode(), -v, n) for n, (v, i) in enumerate(items, 1)]
    return sorted(out)


def made(seed):
    """A hot source, copied texts, sources without kept terms, frequent and rare terms, terms beyond ASCII."""
    pick = random.Random(seed)
    terms = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)] + ["Ünder", "straße", "日本", "É", "z\u0000y"]
    rows = []
    for i in range(400):
        words = [pick.choice(terms[: pick.choice([5, 60, 205])]) for _ in range(pick.randrange(60))]
        source = "hot" if i % 3 == 0 else f"s{pick.randrange(8)}"
        rows.append(row(i, " ".join(w.upper() if pick.random() < 0.3 else w for w in words) + " 7x_y", source, pick.choice(["en", "de", None])))
    rows += [row(1000 + i, rows[pick.randrange(9)][1], pick.choice(["hot", "s1", None, "copies"]), "en") for i in range(200)]
    rows += [row(2000, "lonely", "nowhere", "en"), row(2001, None, "nothing", "en"), row(2002, "solo", "solo", "xx")]
    return rows + [rows[3]] * 5


@pytest.mark.parametrize("seed, bucket, in_row", [(1, 400_000, 1000), (2, 90, 2)])
def test_audit_equals_the_plain_version(spark, odd, monkeypatch, seed, bucket, in_row):
    for name, value in (("BUCKET_ROWS", bucket), ("SOURCES_IN_ROW", in_row)):
        monkeypatch.setattr(divergence, name, value)
    rows = made(seed) + ODD
    got = divergence.audit(spark.createDataFrame(rows, odd.schema).repartition(5)).collect()
    assert sorted(tuple(r) for r in got) == plain(rows)
    assert {r.part for r in got} == {"pair", "term"} and any(r.value == 0 for r in got)


def test_each_text_is_tokenised_once(spark, odd):
    rows = [row(i, f"text {i % 4}", f"s{i % 7}", "en" if i % 2 else "de") for i in range(100)]
    collapsed = divergence.collapse(spark.createDataFrame(rows, odd.schema)).collect()
    assert sorted((r.lang, r.text) for r in collapsed) == [("de", "text 0"), ("de", "text 2"), ("en", "text 1"), ("en", "text 3")]
    assert sum(sum(r.copies) for r in collapsed) == 100


def test_pairs_are_looked_at_some_at_a_time(monkeypatch):
    pick = random.Random(3)
    sources = [f"s{k}" for k in range(12)]
    table = pa.Table.from_pylist(
        [{"lang": "x", "source": s, "term": None, "p": 1 + pick.randrange(40)} for s in sources]
        + [{"lang": "x", "source": s, "term": f"t{k}", "p": 1 + pick.randrange(90)} for k in range(30) for s in pick.sample(sources, 5)],
        pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("p", pa.int64())]),
    )
    whole = divergence._compare(table)
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 3)
    assert divergence._compare(table).equals(whole) and len(whole) == 66


def test_nothing_and_odd_rows(odd, nothing):
    assert divergence.audit(nothing).count() == 0
    assert sorted(tuple(r) for r in divergence.audit(odd).collect()) == plain(ODD)


def test_shares_are_exact_beyond_64_bits(spark):
    many = 9 * 10**17
    frame = spark.createDataFrame([(many, 2 * many, 3), (0, 0, 0), (0, 10**18, 10**9)], "n long, t long, v long")
    got = [r[0] for r in frame.select(divergence.share("n", "t", "v")).collect()]
    assert got == [1 + 10**9 * (many + 5) // (2 * many + 15), 1, 1 + 10**9 * 5 // (10**18 + 5 * 10**9)]
