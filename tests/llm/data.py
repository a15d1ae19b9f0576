"""Documents with all that is awkward, and plain versions of what the operators do."""

from __future__ import annotations

import random
import re

WORDS = "the of and was house river stone green walks quickly under license mit general public apache é ß Überall 東京".split()
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, n_words string, label int, "
    "_row int, part string, first string, kept string"
)


def prose(draw: random.Random, size: int) -> str:
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "", ".", ",", "\n"]) for _ in range(size))


def awkward_rows() -> list[tuple]:
    draw = random.Random(3)
    base = prose(draw, 120)
    words = base.split(" ")
    near = " ".join([*words[:60], "changed", *words[61:]])
    texts = [
        (1, base, "en"), (2, base, "en"), (2, base, "en"), (3, near, "en"), (4, base.upper(), None), (5, None, "en"),
        (6, "", "de"), (7, " \t\n ", "fr"), (8, "one", "de"), (9, "one", "de"), (10, "two words", "es"), (11, "12 34", "es"),
        (None, base, "en"), (None, None, None), (12, prose(draw, 20_000), "en"), (13, "a  b   c ", "en"),
        (14, "x" * 5_000, "fr"), (15, "line one\nline one\n\nline one\r\nline", "fr"), (16, "MIT License, general  public\tlicense", "en"),
        (17, "### $$$ %%% &&& <|>", None), (18, "\x1c\x85\xa0  a b", "de"), (19, "one", "de"), (20, "😀 😀é\U0001f600", "en"),
        (2**40, "a b c d", "en"), (-7, "a b c d", "en"), (21, "a b c", "en"),
    ]
    for key in range(100, 140):
        texts.append((key, prose(draw, draw.randint(1, 90)), draw.choice(["en", "fr"])))
    return [(key, text, lang, f"src{len(text or '') % 4}", 0, "x", "y", 1, 2, "z", "f", "k") for key, text, lang in texts]


def words_of(text: str | None) -> list[str]:
    """Runs of anything but white space, A-Z in lower case."""
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), word) for word in found]


def components(rows: list[tuple[int | None, str | None]], words: int, percent: int) -> list[tuple]:
    """doc_id, size and smallest linked id by comparing all pairs."""
    sets = []
    for _, text in rows:
        found = words_of(text)
        length = min(words, len(found))
        sets.append({tuple(found[i : i + length]) for i in range(len(found) - length + 1)} if found else set())
    parent = {key: key for key, _ in rows if key is not None}

    def top(key):
        while parent[key] != key:
            key = parent[key]
        return key

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    return [(key, len(own), None if key is None else top(key)) for (key, _), own in zip(rows, sets)]
