"""License detection by ordered signature rules, with built-in functions only.

A rule is a regular expression over lower-case words with one space between them, and starts with a word that
is its keyword. Documents without any of the gate phrases are done after a look for those. In the others, each
place where a keyword stands is tried with the rules of that keyword; of overlapping detections the one that
contains the other and has at least its priority stays.
"""

from __future__ import annotations

import json
import re
import re._constants as parts
import re._parser as parser
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import fresh

# What separates words once A-Z are in lower case, and the phrases every scan must find.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# A detection is this many words long at most.
WINDOW = 16
BASE, NAMED, VERSIONED, EXACT = 0, 1, 2, 3
CONFIDENCE = (0.6, 0.7, 0.9, 1.0)

# Literals in most rules, looked for first; gates_of() adds what the other rules need.
GATES = ("licen", "spdx")

_LICENSE = "licen[cs]e"
_V = "(?:version |v )?"

# Families: label, names as words (the first word of each is its keyword), and versions as words.
FAMILIES: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("mit", ("mit", "expat"), ()),
    ("x11", ("x11", "x consortium"), ()),
    ("apache", ("apache", "apache software", "asl"), ("1 0", "1 1", "2 0", "2")),
    ("gpl", ("gnu general public", "gnu gpl", "gpl", "general public"), ("1", "2", "2 0", "3", "3 0")),
    ("lgpl", ("gnu lesser general public", "gnu library general public", "gnu lgpl", "lgpl", "lesser general public"),
     ("2", "2 0", "2 1", "3", "3 0")),
    ("agpl", ("gnu affero general public", "affero general public", "gnu agpl", "agpl"), ("1", "3", "3 0")),
    ("gfdl", ("gnu free documentation", "gfdl"), ("1 1", "1 2", "1 3")),
    ("bsd", ("bsd", "berkeley software distribution", "new bsd", "revised bsd", "simplified bsd", "modified bsd"), ()),
    ("mpl", ("mozilla public", "mpl"), ("1 0", "1 1", "2 0")),
    ("epl", ("eclipse public", "epl"), ("1 0", "2 0")),
    ("edl", ("eclipse distribution",), ("1 0",)),
    ("cddl", ("common development and distribution", "cddl"), ("1 0", "1 1")),
    ("cpl", ("common public", "ibm common public"), ("1 0",)),
    ("cpal", ("common public attribution", "cpal"), ("1 0",)),
    ("eupl", ("european union public", "eupl"), ("1 0", "1 1", "1 2")),
    ("artistic", ("artistic", "perl artistic"), ("1 0", "2 0")),
    ("zlib", ("zlib", "zlib libpng"), ()),
    ("libpng", ("libpng", "png reference library"), ("2",)),
    ("isc", ("isc", "internet systems consortium"), ()),
    ("boost", ("boost software", "bsl"), ("1 0",)),
    ("unlicense", ("unlicense",), ()),
    ("wtfpl", ("wtfpl", "do what the fuck you want to public"), ("2",)),
    ("ofl", ("sil open font", "open font", "ofl"), ("1 0", "1 1")),
    ("osl", ("open software", "osl"), ("1 0", "2 0", "2 1", "3 0")),
    ("afl", ("academic free", "afl"), ("1 2", "2 0", "2 1", "3 0")),
    ("ms-pl", ("microsoft public", "ms pl"), ()),
    ("ms-rl", ("microsoft reciprocal", "ms rl"), ()),
    ("psf", ("python software foundation", "psf", "python"), ("2",)),
    ("php", ("php",), ("3 0", "3 01")),
    ("zpl", ("zope public", "zpl"), ("2 0", "2 1")),
    ("ruby", ("ruby",), ()),
    ("openssl", ("openssl", "ssleay"), ()),
    ("postgresql", ("postgresql", "postgres"), ()),
    ("lppl", ("latex project public", "lppl"), ("1 0", "1 1", "1 2", "1 3")),
    ("cecill", ("cecill",), ("1 0", "1 1", "2 0", "2 1")),
    ("odbl", ("open database", "odbl", "odc open database"), ("1 0",)),
    ("odc-by", ("open data commons attribution", "odc by"), ("1 0",)),
    ("pddl", ("open data commons public domain dedication and", "pddl"), ("1 0",)),
    ("ncsa", ("university of illinois ncsa open source", "ncsa open source", "ncsa"), ()),
    ("upl", ("universal permissive", "upl"), ("1 0",)),
    ("sspl", ("server side public", "sspl"), ("1",)),
    ("busl", ("business source", "busl"), ("1 1",)),
    ("elastic", ("elastic",), ("2", "2 0")),
    ("openrail", ("openrail", "creativeml open rail m", "bigscience rail", "bigcode openrail m"), ()),
    ("llama", ("llama 2 community", "llama 3 community", "llama community"), ()),
    ("vim", ("vim",), ()),
    ("curl", ("curl",), ()),
    ("json", ("json",), ()),
    ("beerware", ("beerware", "beer ware"), ()),
    ("fair", ("fair",), ()),
    ("qpl", ("q public", "qpl"), ("1 0",)),
    ("spl", ("sun public", "sun industry standards source"), ("1 0",)),
    ("apsl", ("apple public source", "apsl"), ("1 0", "1 1", "2 0")),
    ("npl", ("netscape public", "npl"), ("1 0", "1 1")),
    ("nasa", ("nasa open source",), ("1 3",)),
    ("rpl", ("reciprocal public", "rpl"), ("1 1", "1 5")),
)

# Names that are everyday words: a license of that name has "under" before it or "agreement" behind it, or a version.
COMMON = ("artistic", "curl", "elastic", "fair", "json", "php", "python", "ruby", "vim")

# SPDX identifiers as words, of families whose names do not have them. EDL, OpenRAIL and Llama have none there.
SPDX = {"bsd": ("0bsd",), "cpl": ("cpl",), "nasa": ("nasa",), "spl": ("spl", "sissl")}

# Creative Commons: the parts of a name, as short and as long words.
CC_PARTS = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}
CC_KINDS = ("by", "by nc", "by nd", "by sa", "by nc nd", "by nc sa")
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Rules that fit no family: label, pattern (its first word is the keyword), priority.
SINGLE: tuple[tuple[str, str, int], ...] = (
    ("public-domain", "public domain", NAMED),
    ("public-domain", "dedicated to the public domain", VERSIONED),
    ("public-domain", "released into the public domain", VERSIONED),
    ("public-domain", "placed in the public domain", VERSIONED),
    ("cc0", "cc0(?: 1 0)?(?: universal)?", VERSIONED),
    ("cc0", "cc zero(?: 1 0)?", VERSIONED),
    ("cc0", "creative commons zero(?: v?1 0)?(?: universal)?", EXACT),
    ("cc", "creative commons", NAMED),
    ("cc", f"creative commons {_LICENSE}", NAMED),
    ("bsd", f"bsd [234] clause(?: {_LICENSE})?", EXACT),
    ("bsd", f"2 clause bsd(?: {_LICENSE})?", EXACT),
    ("bsd", f"3 clause bsd(?: {_LICENSE})?", EXACT),
    ("bsd", f"4 clause bsd(?: {_LICENSE})?", EXACT),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", EXACT),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", EXACT),
    ("bsd", "redistribution and use in source and binary forms with or without modification", EXACT),
    ("zlib", "this software is provided as is without any express or implied warranty", VERSIONED),
    ("wtfpl", "do what the fuck you want", VERSIONED),
    ("unlicense", "this is free and unencumbered software released into the public domain", EXACT),
    ("proprietary", "all rights reserved", NAMED),
    ("proprietary", f"proprietary {_LICENSE}", NAMED),
    ("proprietary", f"commercial {_LICENSE}", NAMED),
    ("copyleft", "copyleft", NAMED),
    ("gpl", "gplv1", EXACT),
    ("gpl", "gplv2", EXACT),
    ("gpl", "gplv3", EXACT),
    ("lgpl", "lgplv2(?: 1)?", EXACT),
    ("lgpl", "lgplv3", EXACT),
    ("agpl", "agplv3", EXACT),
)


@dataclass(frozen=True)
class Rule:
    """What to call it, the word it starts with, the pattern, and its rank among overlapping rules."""

    label: str
    keyword: str
    pattern: str
    priority: int


def rules_of(
    families: Sequence = FAMILIES, single: Sequence = SINGLE, phrases: dict[str, str] = PHRASES
) -> tuple[Rule, ...]:
    """All rules in order: phrases first, then each family by name, by version and as an identifier."""
    made = [Rule(label, phrase.split()[0], phrase, BASE) for phrase, label in phrases.items()]
    for label, names, versions in families:
        for name in names:
            keyword, number = name.split()[0], "|".join(sorted(versions, key=len, reverse=True))
            own = "" if keyword == "unlicense" else f" {_LICENSE}"
            if name in COMMON:
                made.append(Rule(label, "under", f"under (?:the )?(?:terms of (?:the )?)?{name}{own}", NAMED))
                made.append(Rule(label, keyword, f"{name}{own} agreement", NAMED))
            else:
                made.append(Rule(label, keyword, f"{name}{own}", NAMED))
            if versions:
                made.append(Rule(label, keyword, f"{name}(?: {_LICENSE})? {_V}(?:{number})", VERSIONED))
                made.append(Rule(label, keyword, f"{name}(?: {_LICENSE})? {_V}(?:{number}) (?:only|or (?:any )?later)", EXACT))
        # One rule for all names, the longer ones first, as one of them may start another.
        tags = "|".join(sorted((*names, *SPDX.get(label, ())), key=len, reverse=True))
        made.append(Rule(label, "spdx", f"spdx license identifier (?:{tags})(?: (?:{number}))?", EXACT))
    for kind in CC_KINDS:
        parts, number = kind.split(), "|".join(CC_VERSIONS)
        words = " ".join(CC_PARTS[part] for part in parts)
        made.append(Rule(f"cc-{kind.replace(' ', '-')}", "cc", f"cc {kind}(?: {_LICENSE})?", NAMED + (len(parts) > 1)))
        made.append(Rule(f"cc-{kind.replace(' ', '-')}", "cc", f"cc {kind} (?:{number})", EXACT))
        made.append(Rule(f"cc-{kind.replace(' ', '-')}", "creative", f"creative commons {words}(?: {_LICENSE})?", VERSIONED))
        made.append(
            Rule(
                f"cc-{kind.replace(' ', '-')}", "creative",
                f"creative commons {words} (?:(?:international|unported) )?(?:{number})(?: (?:international|unported))?"
                f"(?: {_LICENSE})?", EXACT,
            )
        )
        made.append(Rule(f"cc-{kind.replace(' ', '-')}", "spdx", f"spdx license identifier cc {kind} (?:{number})", EXACT))
    made += [Rule(label, re.match(r"\w+", pattern)[0], pattern, priority) for label, pattern, priority in single]
    return tuple(made)


def literals_of(pattern: str) -> list[str]:
    """Texts that every match of a pattern contains, with the spaces around the match."""
    found, run = [], " "
    for kind, value in parser.parse(pattern):
        if kind is parts.LITERAL:
            run += chr(value)
        else:
            found, run = [*found, run], ""
    return [text for text in [*found, run + " "] if text.strip()]


def gates_of(rules: Sequence[Rule], common: Sequence[str] = GATES) -> tuple[str, ...]:
    """Phrases of which each match of a rule contains at least one: ``common`` ones, then what each other rule starts with."""
    gates: list[str] = []
    starts = []
    for rule in rules:
        literals = literals_of(rule.pattern)
        if not literals:
            raise ValueError(f"a rule without a literal: {rule.pattern}")
        met = [gate for gate in common if any(gate in text for text in literals)]
        if met:
            gates += met[:1]
        else:
            starts.append(literals[0])
    for text in sorted(starts, key=len):
        if not any(gate in text for gate in gates):
            gates.append(text)
    return tuple(dict.fromkeys(gates))


RULES = rules_of()
_RULE = "array<struct<label:string,keyword:string,pattern:string,priority:int,rule:int>>"


def normalized(text: Column) -> Column:
    """The words in lower case with one space before, between and after them; NULL counts as empty."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    # lower() is quick where all is ASCII; elsewhere it would change more than A-Z.
    plain = F.octet_length(whole) == F.length(whole)
    lowered = F.when(plain, F.lower(whole)).otherwise(F.translate(whole, ascii_uppercase, ascii_lowercase))
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(lowered, BREAKS, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def detected(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with n_words and ``found``: all detections, an array in order of place, and ``kept``.

    A detection has first and last (words, from 0), priority, rule (its number) and label. ``kept`` are
    those that no other detection contains which has a higher priority, or the same and more words, or
    the same in both and an earlier rule. Columns of these names are replaced. NULL and empty texts have
    no words and no detections. No shuffle; long texts are cut into words once, and looked at near keywords.
    """
    added = ["n_words", "found", "kept"]
    rest = [name for name in docs.columns if name.lower() not in added]
    norm_name, words_name, found_name = (fresh(docs.columns, name) for name in ("_norm", "_words", "_found"))
    norm, words, found = F.col(norm_name), F.col(words_name), F.col(found_name)

    gate = F.exists(F.lit(list(gates_of(rules))), lambda phrase: F.contains(norm, phrase))
    listed = [
        {**asdict(rule), "pattern": f"^(?:{rule.pattern})(?= )", "rule": i} for i, rule in enumerate(rules)
    ]
    # A constant, which the planner works out once.
    table = F.from_json(F.lit(json.dumps(listed)), _RULE)
    keywords = F.lit(sorted({rule.keyword for rule in rules}))

    step = docs.withColumn(norm_name, normalized(F.col("text")))
    step = step.withColumn(words_name, F.when(gate, F.split(F.btrim(norm), " ")))

    def at(place: Column) -> Column:
        word = F.get(words, place)
        window = F.concat(F.array_join(F.slice(words, place + 1, F.lit(WINDOW)), " "), F.lit(" "))
        tried = F.transform(
            F.filter(table, lambda rule: rule["keyword"] == word),
            lambda rule: F.struct(
                place.alias("first"),
                (place + _spaces(F.call_function("regexp_extract", window, rule["pattern"], F.lit(0)))).alias("last"),
                rule["priority"].alias("priority"),
                rule["rule"].alias("rule"),
                rule["label"].alias("label"),
                F.rlike(window, rule["pattern"]).alias("matched"),
            ),
        )
        return F.filter(tried, lambda hit: hit["matched"])

    places = F.filter(
        F.transform(words, lambda word, i: F.when(F.array_contains(keywords, word), i)), lambda i: i.isNotNull()
    )
    step = step.withColumn(found_name, F.coalesce(F.flatten(F.transform(places, at)), _none()))

    by_keyword: dict[str, int] = {}
    for rule in rules:
        by_keyword[rule.keyword] = by_keyword.get(rule.keyword, 0) + 1
    near = WINDOW * max(by_keyword.values(), default=1)

    def contained(hit: Column, k: Column) -> Column:
        around = F.slice(found, F.greatest(k + 1 - near, F.lit(1)), F.lit(2 * near))
        length = hit["last"] - hit["first"]
        return F.exists(
            around,
            lambda other: (other["first"] <= hit["first"])
            & (other["last"] >= hit["last"])
            & (
                F.struct(other["priority"], other["last"] - other["first"], -other["rule"])
                > F.struct(hit["priority"], length, -hit["rule"])
            ),
        )

    total = F.when(norm == "  ", F.lit(0)).otherwise(_spaces(norm) - 1).cast("bigint")
    return step.select(
        *[F.col(f"`{name}`") for name in rest],
        total.alias("n_words"),
        found.alias("found"),
        F.filter(found, lambda hit, k: ~contained(hit, k)).alias("kept"),
    )


def _none() -> Column:
    kind = "array<struct<first:int,last:int,priority:int,rule:int,label:string,matched:boolean>>"
    return F.array().cast(kind)


def scanned(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id, n_words, the places of the base phrases, the labels and a score for each row of ``docs``."""
    hits = detected(docs.select("doc_id", "text"), rules)
    base = F.filter(F.col("found"), lambda hit: hit["priority"] == BASE)
    starts = F.transform(base, lambda hit: hit["first"])
    base_labels = F.transform(base, lambda hit: hit["label"])
    labels = F.concat(F.transform(F.col("kept"), lambda hit: hit["label"]), base_labels)
    confidence = F.array(*[F.lit(value) for value in CONFIDENCE])
    best = F.array_max(F.transform(F.concat(F.col("kept"), base), lambda hit: F.get(confidence, hit["priority"])))

    def joined(names: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(names)), ",")

    return hits.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"),
        F.array_max(starts).cast("bigint").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(labels).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"),
    )
