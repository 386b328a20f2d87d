"""Plain single-machine versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACES = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER))


def jump(key: int, shards: int) -> int:
    home, landed = -1, 0
    while landed < shards:
        home = landed
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        landed = int((home + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return home


def drop_lines(texts: list[str | None], min_docs: int, min_chars: int) -> list[tuple[str, int, int]]:
    def key(line: str) -> str:
        return line.strip(SPACES).translate(UPPER)

    split = [(t or "").split("\n") for t in texts]
    found = Counter(k for lines in split for k in {key(x) for x in lines})
    out = []
    for lines in split:
        stay = [x for x in lines if len(key(x)) < min_chars or found[key(x)] < min_docs]
        out.append(("\n".join(stay), len(lines), len(lines) - len(stay)))
    return out


def shingles(text: str | None) -> set[tuple]:
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def components(texts: list[str | None], percent: int) -> list[int]:
    """The smallest position that links reach from each position."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def drop_lines_by_groups(texts: list[str | None], min_groups: int, percent: int) -> list[tuple[str, int, int]]:
    """As drop_lines, but texts that links tie together count once.

    Links are looked for among the texts with a line that ``min_groups`` distinct texts have.
    """

    def keys(text: str) -> set[str]:
        return {x.strip(SPACES).translate(UPPER) for x in text.split("\n")} - {""}

    holders = defaultdict(set)
    for text in {t or "" for t in texts}:
        for k in keys(text):
            holders[k].add(text)
    wide = {k for k, held in holders.items() if len(held) >= min_groups}
    among = sorted({t for k in wide for t in holders[k]})
    group = dict(zip(among, components(among, percent), strict=True))
    gone = {k for k in wide if len({group[t] for t in holders[k] if shingles(t)}) >= min_groups}
    out = []
    for text in texts:
        lines = (text or "").split("\n")
        stay = [x for x in lines if x.strip(SPACES).translate(UPPER) not in gone]
        out.append(("\n".join(stay), len(lines), len(lines) - len(stay)))
    return out


def quality(text: str | None) -> dict[str, int]:
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    places = defaultdict(list)
    for i in range(len(w) - 7):
        places[tuple(w[i : i + 8])].append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_marks": sum(text.count(c) for c in "!?"),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def benchmark_words(text: str | None) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UPPER))


def contamination(text: str | None, items: list[tuple[object, str | None]]) -> tuple:
    """Number of words, of hit words, and the ids found, sorted as strings."""
    w = benchmark_words(text)
    hit, found = set(), set()
    for item, body in items:
        b = benchmark_words(body)
        size = min(10, len(b))
        runs = {tuple(b[i : i + size]) for i in range(len(b) - size + 1)} if b else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in runs:
                hit.update(range(i, i + size))
                found.add(item)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None)
