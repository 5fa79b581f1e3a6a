"""The operators' results once more, by the shortest way and without Spark."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Hashable, Iterable

SPACE = " \t\n\x0b\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def digest(spans: Iterable[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def rules(text: str | None) -> tuple[int, int, int, int, int]:
    words, lines = WORD.findall(text or ""), [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = list(zip(words, words[1:], words[2:]))  # noqa: B905
    often = Counter(windows)
    covered = {i + k for i, window in enumerate(windows) if often[window] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def pii(text: str | None) -> dict[str, list[tuple[int, int]]]:
    text = text or ""

    def digits(span: str) -> str:
        return re.sub("[^0-9]", "", span)

    def found(pattern: str, valid: Callable[[str], bool]) -> list[tuple[int, int]]:
        return [m.span() for m in re.finditer(pattern, text) if valid(m[0])]

    return {
        "email": found(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": found(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": found(r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": found(r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    }


def secrets(text: str | None) -> list[tuple[int, int, str, int]]:
    patterns = [
        ("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 18),
        ("hex", r"[0-9a-f]+", 0, 16),
    ]
    return sorted(
        (m.start(), rank, kind, m.end())
        for rank, (kind, pattern, group, least) in enumerate(patterns)
        for m in re.finditer(pattern, text or "")
        if len(m[group]) >= least
    )


def shingles(text: str | None) -> Counter:
    words = (text or "").encode().lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def weighted_jaccard(a: Counter, b: Counter) -> float:
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def line_shingles(body: str) -> Counter:
    """Five characters from every character; a shorter line is one shingle."""
    return Counter({body[i : i + 5]: 1 for i in range(max(1, len(body) - 4))})


def classes(sets: dict[Hashable, Counter], least: float = 0.8) -> dict[Hashable, Hashable]:
    """The first key, in the dict's order, of every key's component of pairs that are near."""
    order = {key: n for n, key in enumerate(sets)}
    holders, parent = defaultdict(list), {key: key for key in sets}
    for key, parts in sets.items():
        for part in parts:
            holders[part].append(key)
    pairs = {(a, b) for keys in holders.values() for n, b in enumerate(keys) for a in keys[:n]}

    def root(key: Hashable) -> Hashable:
        while parent[key] != key:
            key = parent[key]
        return key

    for a, b in pairs:
        if weighted_jaccard(sets[a], sets[b]) >= least:
            a, b = sorted((root(a), root(b)), key=order.__getitem__)
            parent[b] = a
    return {key: root(key) for key in sets}


def edit_distance_to_any_part(pattern: str, text: str) -> int:
    before = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (c != d)))
        before = now
    return min(before)


def document_lines(text: str | None) -> list[tuple[int, str]]:
    """Numbers and compared forms of the lines that can be copies."""
    bodies = ((n, line.strip(" \t\x0b\f\r").lower()) for n, line in enumerate((text or "").split("\n")))
    return [(n, body) for n, body in bodies if body]
