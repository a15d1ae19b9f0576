from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from datetime import datetime
from string import ascii_lowercase, ascii_uppercase

import pytest
from pyspark.sql import functions as F

from tapeloom.llm import language_id, license_scan, mixing, quality_rules, url_filters
from tests.llm import data


def measures(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, window in enumerate(windows) if times[window] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(awkward):
    want = sorted(((row["doc_id"], *measures(row["text"])) for row in awkward.collect()), key=repr)
    judged = quality_rules.judged(awkward)
    got = judged.select("doc_id", *quality_rules.MEASURES).collect()
    assert sorted(map(tuple, got), key=repr) == want
    for row in judged.collect():
        failed = row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"]
        assert row["base_failed"] == failed and row["kept"] == (row["failed_bits"] == 0)


def test_ablation_counts_what_each_rule_rejects_alone(awkward):
    entries = quality_rules.ledger(awkward.select("doc_id", "text"))
    bits = [row["failed_bits"] for row in entries.collect()]
    for row in quality_rules.ablation(entries, [quality_rules.BASE, quality_rules.STANDARD]).collect():
        policy = quality_rules.BASE if row["policy"] == "base" else quality_rules.STANDARD
        bit = 1 << [rule.name for rule in quality_rules.RULES].index(row["rule"])
        counted = [value & policy.mask() for value in bits]
        assert row["fail"] == sum(bool(value & bit) for value in counted)
        assert row["fail_only_this"] == sum(value == bit for value in counted)
        assert row["rejected"] == sum(value != 0 for value in counted)


def test_kept_documents_keep_their_columns(awkward):
    kept = quality_rules.kept_documents(awkward)
    passed = quality_rules.judged(awkward).where("kept").count()
    assert kept.columns == awkward.columns and kept.count() == passed > 0


def test_language_on_held_out_documents(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/sf0.01/documents.parquet")
    got = language_id.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert held.count() > 150 and held.where("lang_pred = lang").count() / held.count() > 0.98


def test_language_of_awkward_documents(awkward, nothing):
    got = language_id.predicted(awkward)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    for row in got.join(awkward.select("doc_id", "text").distinct(), "doc_id").collect():
        lettered = any(map(str.isalpha, row["text"] or ""))
        assert (row["lang_pred"] == "und") == (not lettered) and 0 <= row["score"] <= 1
    known = language_id.known_documents(awkward, least=0.0)
    assert known.columns == awkward.columns
    assert known.count() == sum(any(map(str.isalpha, row["text"] or "")) for row in awkward.collect())
    untaught = language_id.with_language(awkward, language_id.train(nothing))
    assert {row["lang_pred"] for row in untaught.collect()} == {"und"}


def test_too_many_languages_are_refused(awkward):
    with pytest.raises(ValueError, match="languages"):
        language_id.train(awkward, language_id.Settings(languages=2))


def license_words(text: str | None) -> list[str]:
    lowered = (text or "").translate(str.maketrans(ascii_uppercase, ascii_lowercase))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def license_hits(words: list[str]) -> list[tuple]:
    """All rules at all places, and those that no other contains with more right."""
    hits = []
    for i in range(len(words)):
        window = " ".join(words[i : i + license_scan.WINDOW]) + " "
        for number, rule in enumerate(license_scan.RULES):
            found = re.match(f"(?:{rule.pattern})(?= )", window)
            if found:
                hits.append((i, i + found[0].count(" "), rule.priority, number, rule.label))
    return hits


def test_license_scan_against_all_rules_everywhere(spark, awkward):
    texts = [
        "Released under the MIT License.", "Licensed under CC BY-NC 4.0 and the GNU Lesser General Public License version 2.1 or later",
        "SPDX-License-Identifier: Apache 2 0", "mit license mit license; Apache License, Version 2.0! all rights reserved",
        "spdx license identifier cc by sa 4 0 general public license general public license v3", "MITLicense mit\tlicense\x00é mit licence",
        "dual licensed bsd 3 clause license creative commons attribution non commercial 4 0 international", "public domain copyleft cc0 1 0 universal",
    ]
    rows = [(i, text) for i, text in enumerate(texts)] + [(100 + i, row["text"]) for i, row in enumerate(awkward.collect()) if len(row["text"] or "") < 9_000]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = {row["doc_id"]: row for row in license_scan.scanned(docs).collect()}
    for key, text in rows:
        words = license_words(text)
        hits = license_hits(words)
        base = [hit for hit in hits if hit[2] == license_scan.BASE]
        rank = lambda hit: (hit[2], hit[1] - hit[0], -hit[3])
        kept = [
            hit for hit in hits if not any(o[0] <= hit[0] and o[1] >= hit[1] and rank(o) > rank(hit) for o in hits)
        ]
        row = got[key]
        assert row["n_words"] == len(words)
        starts = [hit[0] for hit in base]
        assert (row["n_base"], row["first_word"], row["last_word"]) == (len(base), min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted({hit[4] for hit in base}))
        assert row["labels"] == ",".join(sorted({hit[4] for hit in [*kept, *base]}))
        assert row["score"] == max((license_scan.CONFIDENCE[hit[2]] for hit in [*kept, *base]), default=0.0)
    assert got[1]["labels"] == "cc-by-nc,gpl,lgpl" and got[1]["base_labels"] == "gpl" and got[0]["labels"] == "mit"


def test_rules_start_with_their_keyword():
    for rule in license_scan.RULES:
        assert re.match(r"\w+", rule.pattern)[0] == rule.keyword


def test_everyday_words_need_a_neighbour(spark):
    cases = [
        ("a fair license plate", ""), ("the json license field", ""), ("a python license test", ""), ("poets take artistic license", ""),
        ("Available under the JSON License.", "json"), ("under the terms of the Fair License", "fair"), ("Python License Agreement", "psf"),
        ("Artistic License 2.0", "artistic"), ("Elastic License 2.0", "elastic"), ("zlib license", "zlib"),
    ]
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "doc_id int, text string")
    got = {row["doc_id"]: row["labels"] for row in license_scan.scanned(docs).collect()}
    assert [(text, got[i]) for i, (text, _) in enumerate(cases)] == cases


def least_match(parsed) -> str:
    """A text that a parsed pattern matches, without anything optional in it."""
    text = ""
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            text += chr(value)
        elif name == "IN":
            text += chr(value[0][1] if str(value[0][0]) == "LITERAL" else value[0][1][0])
        elif name == "BRANCH":
            text += min((least_match(branch) for branch in value[1]), key=len)
        elif name == "SUBPATTERN":
            text += least_match(value[3])
        else:
            assert name == "MAX_REPEAT"
            text += least_match(value[2]) * value[0]
    return text


def test_a_document_with_one_match_and_nothing_else_is_found(spark):
    texts = [least_match(re._parser.parse(rule.pattern)) for rule in license_scan.RULES]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {row["doc_id"]: row for row in license_scan.detected(docs).select("doc_id", F.col("found.rule").alias("rules")).collect()}
    assert [i for i, text in enumerate(texts) if i not in got[i]["rules"]] == []
    texts = ["All rights reserved.", "Apache 2.0", "MPL-2.0", "GNU General Public version 3", "Do what the fuck you want", "CC Zero"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    labels = {row["doc_id"]: row["labels"] for row in license_scan.scanned(docs).collect()}
    assert [labels[i] for i in range(len(texts))] == ["proprietary", "apache", "mpl", "gpl", "wtfpl", "cc0"]


def test_spdx_identifiers_of_all_families(spark):
    tags = {
        "mit": "MIT", "x11": "X11", "apache": "Apache-2.0", "gpl": "GPL-3.0-or-later", "lgpl": "LGPL-2.1-only", "agpl": "AGPL-3.0-only",
        "gfdl": "GFDL-1.3-or-later", "bsd": "0BSD", "mpl": "MPL-2.0", "epl": "EPL-2.0", "cddl": "CDDL-1.0", "cpl": "CPL-1.0",
        "cpal": "CPAL-1.0", "eupl": "EUPL-1.2", "artistic": "Artistic-2.0", "zlib": "Zlib", "libpng": "libpng-2.0", "isc": "ISC",
        "boost": "BSL-1.0", "unlicense": "Unlicense", "wtfpl": "WTFPL", "ofl": "OFL-1.1", "osl": "OSL-3.0", "afl": "AFL-3.0",
        "ms-pl": "MS-PL", "ms-rl": "MS-RL", "psf": "PSF-2.0", "php": "PHP-3.01", "zpl": "ZPL-2.1", "ruby": "Ruby", "openssl": "OpenSSL",
        "postgresql": "PostgreSQL", "lppl": "LPPL-1.3c", "cecill": "CECILL-2.1", "odbl": "ODbL-1.0", "odc-by": "ODC-By-1.0",
        "pddl": "PDDL-1.0", "ncsa": "NCSA", "upl": "UPL-1.0", "sspl": "SSPL-1.0", "busl": "BUSL-1.1", "elastic": "Elastic-2.0",
        "vim": "Vim", "curl": "curl", "json": "JSON", "beerware": "Beerware", "fair": "Fair", "qpl": "QPL-1.0", "spl": "SPL-1.0",
        "apsl": "APSL-2.0", "npl": "NPL-1.1", "nasa": "NASA-1.3", "rpl": "RPL-1.5",
    }
    assert {label for label, _, _ in license_scan.FAMILIES} - set(tags) == {"edl", "openrail", "llama"}
    cases = [*tags.items(), ("spl", "SISSL"), ("bsd", "BSD-3-Clause"), ("psf", "Python-2.0"), ("cc0", "CC0-1.0")]
    docs = spark.createDataFrame([(i, f"SPDX-License-Identifier: {tag}") for i, (_, tag) in enumerate(cases)], "doc_id int, text string")
    got = {row["doc_id"]: row["labels"] for row in license_scan.scanned(docs).collect()}
    assert [(got[i], tag) for i, (_, tag) in enumerate(cases)] == cases


def test_url_entries_hold_until_the_next_one(spark):
    day = lambda n: datetime(2024, 1, n)
    entries = [
        ("l", "example.com", day(5), "add"), ("l", "example.com", day(10), "remove"), ("l", "example.com", day(10), "add"),
        ("l", "example.com", day(20), "add"), ("l", "example.com", day(20), "add"), ("m", "a.example.com", day(1), "add"),
        ("m", "=b.example.com/x?q", day(1), "add"), (None, "example.com", day(1), "add"), ("n", None, day(1), "add"),
        ("n", "example.com", None, "add"), ("n", "example.com", day(1), "what"),
    ]
    captures = [
        (1, "http://www.example.com/", day(4)), (1, "http://www.example.com/", day(5)), (2, "http://example.com:80/", day(9)),
        (2, "http://example.com:80/", day(9)), (3, "HTTP://EXAMPLE.com./", day(10)), (4, "//u@a.example.com/", day(25)),
        (5, "https://b.example.com/x?q#part", day(15)), (6, "http://notexample.com", day(25)), (7, None, day(25)), (8, "x", day(25)),
        (9, "http://example.com", None), (None, "http://example.com", day(25)),
    ]
    got = url_filters.judged(
        spark.createDataFrame(captures, "page_id int, url string, fetched_at timestamp").withColumn("lists", F.lit("x")),
        spark.createDataFrame(entries, "list string, key string, dated timestamp, action string"),
    )
    found = sorted(((row["page_id"] or 0, row["fetched_at"].day if row["fetched_at"] else 0, row["lists"], row["n_active"]) for row in got.collect()))
    assert found == [
        (0, 25, "l", 1), (1, 4, "", 0), (1, 5, "l", 1), (2, 9, "l", 1), (2, 9, "l", 1), (3, 10, "", 0), (4, 25, "l,m", 2),
        (5, 15, "m", 1), (6, 25, "", 0), (7, 25, "", 0), (8, 25, "", 0), (9, 0, "", 0),
    ]


def test_hosts_of_many_labels_meet_their_own_and_every_higher_entry(spark):
    host, at = "a.b.c.d.e.f.g.h.example.com", datetime(2024, 1, 2)
    captures = [(i, f"http://{name}/x", at) for i, name in enumerate([host, f"z.{host}", f"z{host}", host[2:]])]
    entries = [("own", host, datetime(2024, 1, 1), "add"), ("above", host[2:], datetime(2024, 1, 1), "add")]
    got = url_filters.judged(
        spark.createDataFrame(captures, "page_id int, url string, fetched_at timestamp"),
        spark.createDataFrame(entries, "list string, key string, dated timestamp, action string"),
    )
    found = {row["page_id"]: (row["blocked"], row["lists"]) for row in got.collect()}
    assert found == {0: (True, "above,own"), 1: (True, "above,own"), 2: (True, "above"), 3: (True, "above")}


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_rows": 20}])
def test_url_judgement_is_one_in_every_form(spark, testdata, limits):
    pages = spark.read.parquet(f"{testdata}/sf0.01/pages.parquet")
    both = url_filters.captures_of(pages), url_filters.entries_of(pages)
    want = sorted(map(tuple, url_filters.judged(*both).collect()))
    assert sorted(map(tuple, url_filters.judged(*both, **limits).collect())) == want


def split_budget(budget: int, children: list[tuple]) -> dict:
    """children: name, capacity, weight. Full ones first, then the rest by weight."""
    given, left, rest = {}, list(children), budget
    while left:
        total = sum(weight for _, _, weight in left)
        full = [(name, cap) for name, cap, weight in left if cap * total <= rest * weight]
        if not full:
            return given | {name: rest * weight // total for name, _, weight in left}
        # One at a time, from the least for its weight.
        name, cap, weight = min(left, key=lambda c: (c[1] * 1_000_000_000 / c[2], str(c[0])))
        given[name], rest = cap, rest - cap
        left = [child for child in left if child[0] != name]
    return given


@pytest.mark.parametrize("per_mille,epochs", [(1000, 2), (500, 1), (3000, 3)])
def test_mixing_budgets_and_choice(spark, testdata, per_mille, epochs):
    docs = mixing.leaves_of(spark.read.parquet(f"{testdata}/sf0.01/documents.parquet")).persist()
    targets = mixing.Targets(mixing.TARGETS.weights, per_mille, epochs)
    rows = docs.collect()
    tokens = defaultdict(int)
    for row in rows:
        for depth in range(4):
            tokens[(row["domain"], row["lang"], row["source"])[:depth]] += row["tokens"]
    budget = {(): tokens[()] * per_mille // 1000}
    for depth, level in enumerate(mixing.LEVELS):
        for parent in [path for path in tokens if len(path) == depth]:
            children = [path for path in tokens if len(path) == depth + 1 and path[:depth] == parent]
            entries = [(path, tokens[path] * epochs, targets.weights[level].get(path[-1], 1)) for path in children]
            budget |= split_budget(budget[parent], entries)
    got = {tuple(row[name] for name in mixing.LEVELS): row["budget"] for row in mixing.budgets(docs, targets).collect()}
    assert got == {path: amount for path, amount in budget.items() if len(path) == 3}

    chosen = mixing.selected(docs, targets, piece=7).collect()
    whole = mixing.selected(docs, targets, piece=10**9).collect()
    assert sorted(map(tuple, chosen)) == sorted(map(tuple, whole))
    taken, uses = defaultdict(int), Counter()
    for row in chosen:
        taken[(row["domain"], row["lang"], row["source"])] += row["taken"]
        uses[row["doc_id"]] += 1
        assert 0 < row["taken"] <= row["tokens"]
    assert {path: amount for path, amount in got.items() if amount} == dict(taken)
    assert max(uses.values()) <= epochs
    docs.unpersist()


def test_mixing_follows_the_seed(spark):
    docs = spark.createDataFrame([(i, "d", "l", "s", 10) for i in range(100)], "doc_id int, domain string, lang string, source string, tokens bigint")
    pick = lambda seed: {row["doc_id"] for row in mixing.selected(docs, mixing.Targets(per_mille=500, seed=seed)).collect()}
    assert pick("a") == pick("a") != pick("b") and len(pick("a")) == 50


def test_mixed_documents_keep_columns(awkward):
    mixed = mixing.mixed_documents(awkward, mixing.Targets(epochs=1))
    assert mixed.columns == awkward.columns
    assert mixed.count() == sum(bool(data.words_of(row["text"])) for row in awkward.collect())


def plain_language(rows, settings):
    """Naive Bayes one n-gram at a time; rows of id, text and label, of which all but one fold teach."""

    def buckets(text):
        points, found = [ord(c) for c in f" {text.lower()} "], []
        for order in settings.orders:
            for at in range(len(points) - order + 1):
                mixed = order
                for point in points[at : at + order]:
                    mixed = ((mixed ^ point) * 0x9E3779B97F4A7C15) % 2**64
                    mixed ^= mixed >> 29
                found.append(mixed % settings.buckets)
        return found

    counts, texts = {}, Counter()
    for key, text, lang in rows:
        if text is not None and lang is not None and zlib.crc32(("" if key is None else str(key)).encode()) % 4 != 2:
            counts.setdefault(lang, Counter()).update(buckets(text))
            texts[lang] += 1
    for key, text, _ in rows:
        held_out = zlib.crc32(("" if key is None else str(key)).encode()) % 4 == 2
        if not any(c.isalpha() for c in text or ""):
            yield key, held_out, "und", 0.0
            continue
        found, sums = buckets(text), {}
        for lang, own in sorted(counts.items()):
            total = sum(own.values()) + settings.smoothing * settings.buckets
            sums[lang] = math.log(texts[lang] / sum(texts.values())) + sum(math.log((own[b] + settings.smoothing) / total) for b in found)
        best, scale = max(sums, key=sums.get), min(1, settings.evidence / len(found))
        yield key, held_out, best, 1 / sum(math.exp((value - sums[best]) * scale) for value in sums.values())


def test_languages_are_those_of_a_plain_model(awkward):
    settings = language_id.Settings(buckets=512)
    rows = [(row["doc_id"], row["text"], row["lang"]) for row in awkward.collect()]
    want = sorted(plain_language(rows, settings), key=repr)
    got = sorted(map(tuple, language_id.predicted(awkward, settings).collect()), key=repr)
    assert [row[:3] for row in got] == [row[:3] for row in want]
    assert [row[3] for row in got] == pytest.approx([row[3] for row in want], rel=1e-3)
