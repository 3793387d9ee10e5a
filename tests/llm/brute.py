"""Plain definitions of the results, to hold the operators against."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def quality(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": dup, "n_repeat_words": len(repeated), "base_failed": n < 50 or 100 * len(repeated) > 50 * n,
    }


SECRETS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    found = []
    for order, (kind, (pattern, group, least)) in enumerate(SECRETS.items()):
        for m in re.finditer(pattern, text or "", re.A):
            if len(m[group]) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(lower(text or ""))


def shingles(text: str | None, size: int) -> frozenset:
    words = words_of(text)
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*[words[k:] for k in range(size)], strict=False))


def components(texts: dict, size: int, percent: int = 80) -> dict:
    """doc_id -> smallest doc_id reachable over similar pairs; all pairs are compared."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in sorted(texts) if sets[i]]
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def containment(texts: dict, items: list[tuple], window: int = 10) -> dict:
    """doc_id -> (n_words, n_hit, n_items, sorted item ids)."""
    known: dict[tuple, set] = {}
    for item, text in items:
        words = BENCH_WORD.findall(lower(text or ""))
        for s in range(max(1, len(words) - window + 1) if words else 0):
            known.setdefault(tuple(words[s : s + window]), set()).add(item)
    lengths = {len(w) for w in known}
    out = {}
    for doc, text in texts.items():
        words = BENCH_WORD.findall(lower(text or ""))
        hit, found = set(), set()
        for n in lengths:
            for s in range(len(words) - n + 1):
                if tuple(words[s : s + n]) in known:
                    hit |= set(range(s, s + n))
                    found |= known[tuple(words[s : s + n])]
        out[doc] = (len(words), len(hit), len(found), sorted(map(str, found)))
    return out
