"""Plain versions of the operators, from their definitions, and a table of awkward documents."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, h long, at int"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def awkward_rows(seed: int = 3) -> list[tuple]:
    """Nulls, empty and long texts, copies, near copies, shared passages, repeated rows and clashing column names."""
    rng = random.Random(seed)
    shared, base = sentence(rng, 60), sentence(rng, 120)
    changed = base.split()
    changed[60] = "other"
    texts = [
        None, "", "  \n\t ", "one", "Two words", "A b c", base, base, base.upper(), " ".join(changed), base + "  \n ",
        shared, sentence(rng, 40) + " " + shared + " " + sentence(rng, 40), sentence(rng, 20) + "\n" + shared,
        "ab " * 300, "x" * 5000, sentence(rng, 6000), "Zoë naïve café 中文 字 😀 " * 12, sentence(rng, 34), sentence(rng, 35),
        "line one here\nline one here\n\nline two\nline one here", "same same\tsame\x0bsame\x0csame\rsame", "\x1c\x85\xa0 odd spaces　",
        "mail a.b@x.org or c@d.e@f.gh 1.2.3.4 999.1.1.1 4111 1111 1111 1111 +1 (555) 010-9999 +12",
        'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and 4111111111111112 then 000255.1.2.3.4.5.6.7 x@y.z_q@r.s',
    ]
    rows = [(i, t, "en", "s", 7, "clash", i, 1) for i, t in enumerate(texts)]
    return [*rows, rows[7], rows[7], (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def words(text):
    return WORD.findall(text or "")


def repeats(rows, width):
    """{row number: (words, removed, sha256 of what stays)}"""
    own = [words(r[1]) for r in rows]
    count = Counter(tuple(w[s : s + width]) for w in own for s in range(len(w) - width + 1))
    out = []
    for w in own:
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            if count[tuple(w[s : s + width])] > 1:
                gone[s : s + width] = [True] * width
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


def base_statistics(text):
    w = words(text)
    count = Counter(tuple(w[s : s + 8]) for s in range(len(w) - 7))
    again = [False] * len(w)
    for s in range(len(w) - 7):
        if count[tuple(w[s : s + 8])] > 1:
            again[s : s + 8] = [True] * 8
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 20 or 100 * sum(again) > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), sum(again), failed


def fingerprint(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, close):
    """Smallest index reachable over pairs that are close."""
    label = list(range(len(values)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if close(values[i], values[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    def valid(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 8 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]
