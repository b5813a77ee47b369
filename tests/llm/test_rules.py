"""Quality rules, licenses and shards against plain versions."""

import random
import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import product

import pytest

from seawarden.llm import licenses, quality_rules, sharding
from seawarden.session import shared_folder
from tests.llm.conftest import ODD, row

WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    threes = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k, three in enumerate(zip(words, words[1:], words[2:])) if threes[three] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def lines_of(text):
    return [(tuple(WORD.findall(line.translate(LOW)))) for line in (text or "").split("\n") if WORD.search(line)]


def expected(rows):
    holders, hosts = defaultdict(set), defaultdict(set)
    for doc_id, text, _, source, *_ in rows:
        hosts[source or ""].add(text or "")
        for line in lines_of(text):
            holders[source or "", line].add(text)
    out = []
    for doc_id, text, _, source, *_ in rows:
        *counts, failed = base(text)
        host = source or ""
        gone = [line for line in lines_of(text) if len(holders[host, line]) > max(2, min(0.1 * len(hosts[host]), 200))]
        removed = sum(map(len, gone))
        out.append((doc_id, *counts, failed, not failed and counts[0] - removed >= 0.3 * counts[0], removed))
    return sorted(out)


def boilerplate():
    """40 documents of one host with a shared line, five of which hold little else; copies count once."""
    shared = "All Pages  carry this\tlong navigation line " + "nav " * 60
    own = [" ".join(f"w{i}x{k}" for k in range(80)) for i in range(35)] + ["short rest"] * 5
    rows = [row(i, f"{shared.upper() if i % 2 else shared}\n{text} {i}\n", "host") for i, text in enumerate(own)]
    return rows + [row(100 + i, "copied " * 2 + " ".join(f"c{k}" for k in range(70)), "host") for i in range(60)]


@pytest.mark.parametrize("rows", [ODD, boilerplate()], ids=["odd", "boilerplate"])
def test_quality_rules_equal_the_plain_version(spark, odd, rows):
    docs = spark.createDataFrame(rows, odd.schema)
    got = quality_rules.judge(docs).collect()
    assert sorted(tuple(r) for r in got) == expected(rows)


def test_quality_rules_on_the_documents(docs):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    assert sorted(tuple(r) for r in quality_rules.judge(docs).collect()) == expected(rows)


def crowd():
    """Hosts of 3 and 30 documents with a line in 2, 3 and 4 of them, and one of 2,600 with lines in 200 and 201."""
    own = [" ".join(f"o{i}x{k}" for k in range(60)) for i in range(2633)]
    rows = [row(i, f"line of two\n{own[i]}" if i < 2 else own[i], "three") for i in range(3)]
    rows += [row(i, ("line of three\n" if i < 6 else "") + ("line of four\n" if i < 7 else "") + own[i], "thirty") for i in range(3, 33)]
    rows += [row(i, ("two hundred\n" if i < 233 else "") + ("and one\n" if i < 234 else "") + own[i], "many") for i in range(33, 2633)]
    return rows


def test_line_limits_act_in_small_and_in_large_hosts(spark, odd, monkeypatch):
    rows = crowd()
    docs = spark.createDataFrame(rows, odd.schema)
    for most in (quality_rules.BROADCAST_LINES, 0):
        monkeypatch.setattr(quality_rules, "BROADCAST_LINES", most)
        got = quality_rules.judge(docs).collect()
        assert sorted(tuple(r) for r in got) == expected(rows)
        removed = Counter((r.doc_id < 33, r.removed_words) for r in got)
        assert removed == {(True, 0): 29, (True, 3): 4, (False, 0): 2399, (False, 2): 201}
        assert quality_rules.clean(docs).where("text LIKE '%line of four%' OR text LIKE '%and one%'").count() == 0


def test_lines_above_the_limit_are_cut_and_depleted_documents_go(spark, odd, nothing):
    rows = boilerplate()
    docs = spark.createDataFrame(rows, odd.schema)
    kept = {r.doc_id: r for r in quality_rules.clean(docs).collect()}
    assert set(kept) == {r[0] for r in expected(rows) if r[-2]} and set(range(35)) <= set(kept)
    assert kept[3].text == " ".join(f"w3x{k}" for k in range(80)) + " 3\n" and kept[3].n_chars == len(kept[3].text)
    assert quality_rules.clean(docs).dtypes == docs.dtypes
    assert quality_rules.judge(nothing).count() == quality_rules.clean(nothing).count() == 0


def test_license_scan_equals_the_plain_version(docs, odd, nothing, texts_of):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def plain(doc_id, text):
        words = word.findall((text or "").translate(LOW))
        places, labels = [], set()
        for phrase, label in licenses.BASE.items():
            parts = phrase.split()
            for k in range(len(words)):
                if words[k : k + len(parts)] == parts:
                    places.append(k)
                    labels.add(label)
        return doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))

    for given, rows in ((docs, texts_of.items()), (odd, [x[:2] for x in ODD])):
        got = licenses.scan(given).collect()
        assert sorted(map(repr, (tuple(r)[:6] for r in got))) == sorted(repr(plain(*x)) for x in rows)
        assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert licenses.scan(nothing).count() == licenses.spans(nothing).count() == 0


@pytest.mark.parametrize(
    "text, labels",
    [
        ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
        ("GNU Lesser General Public License, version 2.1 or later", "gpl,lgpl-2.1-or-later"),
        ("under the terms of the GNU General Public License v3", "gpl,gpl-3.0"),
        ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "cc-by-nc-sa-4.0"),
        ("https://creativecommons.org/licenses/by-sa/3.0/", "cc-by-sa-3.0"),
        ("CC BY-NC-ND 2.5 and later CC-BY 4.0", "cc-by,cc-by-4.0,cc-by-nc-nd-2.5"),
        ("Released under the MIT License.", "mit"),
        ("All rights reserved. Copyright (c) 2020", "copyright,reserved"),
        ("mit dem Auto, ohne Lizenz", ""),
    ],
)
def test_license_labels(text, labels):
    assert licenses.scanner().scan(text.encode())[5] == labels


def sample(parsed, pick):
    """A text that a parsed pattern matches; choices and repeats are drawn."""
    out = ""
    for kind, value in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            out += chr(value)
        elif kind == "NOT_LITERAL":
            out += "q" if value != ord("q") else "x"
        elif kind == "IN":
            name, chosen = pick.choice(value)
            out += chr(chosen if str(name) == "LITERAL" else pick.randint(*chosen))
        elif kind == "MAX_REPEAT":
            least, most, inner = value
            out += "".join(sample(inner, pick) for _ in range(pick.randint(least, min(most, least + 2))))
        elif kind == "SUBPATTERN":
            out += sample(value[-1], pick)
        elif kind == "BRANCH":
            out += sample(pick.choice(value[1]), pick)
        else:
            assert kind in ("ASSERT", "ASSERT_NOT"), kind
    return out


def test_matches_contain_the_keyword_of_their_rule():
    pick = random.Random(11)
    for rule in licenses.build_rules():
        parsed = re._parser.parse(rule.pattern.pattern)
        for _ in range(30):
            text = f" {sample(parsed, pick)} "
            assert rule.pattern.search(text), (rule, text)
            assert rule.keyword in text, (rule, text)


@pytest.mark.parametrize(
    "text, labels, score",
    [
        ("This is free and unencumbered software released into the public domain.", "unlicense", 0.95),
        ("WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS for", "gpl", 0.95),
    ],
)
def test_license_sentences_are_found_on_their_own(text, labels, score):
    assert licenses.scanner().scan(text.encode())[5:] == (labels, score)


def test_contained_detections_are_suppressed_and_rules_are_many():
    found = licenses.scanner().detections(b" gnu general public license version 2 ")
    assert [rule.label for _, _, rule in found] == ["gpl-2.0"] and len(licenses.build_rules()) > 200


def test_detections_equal_a_scan_by_all_rules(texts_of):
    """Labels, score and spans against every rule without keywords, suppressed by comparing all pairs."""
    own, pick = licenses.scanner(), random.Random(3)
    rules = licenses.build_rules()
    made = [" ".join(sample(re._parser.parse(pick.choice(rules).pattern.pattern), pick) for _ in range(9)) for _ in range(150)]
    for text in made + [t or "" for t in list(texts_of.values())[:60]]:
        plain = " " + " ".join(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate(LOW))) + " "
        found = [(m.start(), m.end(), rule) for rule in rules for m in rule.pattern.finditer(plain)]
        found.sort(key=lambda x: (x[2].priority, x[0] - x[1], x[0], x[2].label))
        taken = []
        for a, b, rule in found:
            if not any(c <= a and b <= d for c, d, _ in taken):
                taken.append((a, b, rule))
        got = own.detections(plain.encode())
        assert sorted((a, b, r.label) for a, b, r in got) == sorted((a, b, r.label) for a, b, r in taken)
        base = [label for phrase, label in licenses.BASE.items() if f" {phrase} " in plain]
        _, _, _, _, _, labels, score = own.scan(text.encode())
        assert labels == ",".join(sorted({*base, *(r.label for _, _, r in taken)}))
        assert score == max([r.confidence for _, _, r in taken] + [0.5] * bool(base), default=0.0)


@pytest.mark.parametrize("phrase", ["cc by ", "mit license "])
def test_a_long_text_of_licenses_is_read_once(phrase):
    """Six megabytes of detections: four times the text takes about four times as long, not sixteen times."""
    took = {}
    for size in (1_500_000, 6_000_000):
        raw = (phrase * (size // len(phrase))).encode()
        began = time.process_time()
        licenses.scanner().scan(raw)
        took[size] = time.process_time() - began
    assert took[6_000_000] < 8 * took[1_500_000]


@pytest.mark.parametrize("n, bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(n, bits):
    points = sorted(product(range(1 << bits), repeat=n), key=lambda p: sharding.hilbert_index(p, bits))
    assert sorted(sharding.hilbert_index(p, bits) for p in points) == list(range(len(points)))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(points, points[1:]))


@pytest.mark.parametrize("part_rows", [1, 3, 1_000_000])
def test_shards_are_even_and_complete(odd, docs, nothing, part_rows):
    for given in (odd, docs):
        source = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in given.collect())
        got = sharding.shard(given, part_rows=part_rows).collect()
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == source
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        sizes = [len(slots[k]) for k in range(16)]
        assert max(sizes) - min(sizes) <= 1
        assert sorted(got, key=lambda r: (r.shard, r.slot)) == sorted(got, key=lambda r: (r.curve_place, r.shard, r.slot))
    assert sharding.shard(nothing).count() == 0


def test_steps_take_whole_values_and_the_whole_grid(spark):
    """Long sources that differ at their end only, one of them a third of all rows; against a plain cumulative share."""
    names = ["https://example.org/" + c for c in "abcdefghijkl"]
    held = [60, 3, 3, 100, 4, 30, 20, 20, 20, 20, 10, 10]
    rows = [(name,) for name, n in zip(names, held) for _ in range(n)]
    found = sharding.text_steps(spark.createDataFrame(rows, "source string").repartition(5), "source", 16, shared_folder(spark, "steps"))
    expected, before = {}, 0
    for name, n in zip(names, held):
        expected[name] = (2 * before + n) * 16 // (2 * sum(held))
        before += n
    assert {r.value: r.step for r in found.collect()} == expected and max(expected.values()) == 15


def test_written_shards_hold_every_row_in_order_and_are_skipped(spark, docs, odd, tmp_path):
    for name, given in (("odd", odd), ("docs", docs)):
        ranges = sharding.write(given, f"{tmp_path}/{name}").collect()
        columns = [c for c in given.columns if c != "shard"]
        stored = spark.read.parquet(f"{tmp_path}/{name}/rows")
        assert Counter(map(repr, stored.select(*columns).collect())) == Counter(map(repr, given.select(*columns).collect()))
        assert {r.shard: r["rows"] for r in ranges} == Counter(r.shard for r in stored.collect())
    values = Counter(r.source or "" for r in docs.collect())
    skipped = []
    for source in values:
        found = sharding.read(spark, f"{tmp_path}/docs", "source", source, source).collect()
        assert len(found) == values[source]
        skipped.append(sum(not r.least_source <= source <= r.greatest_source for r in ranges))
    assert sum(skipped) / len(skipped) >= 6
    assert len(sharding.read(spark, f"{tmp_path}/docs", "size", 100, 900).collect()) == sum(
        100 <= len((r.text or "").encode()) + 1 <= 900 for r in docs.collect()
    )
