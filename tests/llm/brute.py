"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SECRET = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = ("assign", "access", "hex")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def ledger(text: str | None) -> dict:
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return {
        "n_words": len(own),
        "word_chars": sum(map(len, own)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(own) < 50 or 100 * len(covered) > 50 * len(own),
    }


def line_dedup(rows: list[tuple]) -> list[tuple[int, int, str]]:
    """Lines, dropped lines and kept text of rows (id, text)."""
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(list)
    for row in rows:
        for k in {key(line) for line in (row[1] or "").split("\n")}:
            holders[k].append(row[0] if row[0] is not None else -math.inf)
    out = []
    for row in rows:
        own = row[0] if row[0] is not None else -math.inf
        lines = (row[1] or "").split("\n")
        stay = [
            line for line in lines
            if len(k := key(line)) < 20 or len(holders[k]) < 3 or max(holders[k]) == own
        ]
        out.append((len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def contamination(text: str | None, items: list[tuple]) -> tuple[int, int, list[str]]:
    own = ITEM_WORD.findall(lower(text or ""))
    hit, found = set(), set()
    for item, content in items:
        test = ITEM_WORD.findall(lower(content or ""))
        size = min(10, len(test))
        windows = {tuple(test[i : i + size]) for i in range(len(test) - size + 1)} if size else set()
        for i in range(len(own) - size + 1 if size else 0):
            if tuple(own[i : i + size]) in windows:
                hit.update(range(i, i + size))
                if item is not None:
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


def near_items(text: str | None, items: list[tuple], slack: int) -> list[str]:
    """Items with a window whose words all stand in a few consecutive words, as often as in the window."""
    own = ITEM_WORD.findall(lower(text or ""))
    found = set()
    for item, content in items:
        test = ITEM_WORD.findall(lower(content or ""))
        size = min(10, len(test))
        needs = [Counter(test[i : i + size]) for i in range(len(test) - size + 1)] if size else []
        stretches = [Counter(own[i : i + size + slack]) for i in range(max(len(own) - size - slack + 1, 1))]
        if item is not None and any(not need - have for need in needs for have in stretches):
            found.add(str(item))
    return sorted(found)


def shingles(text: str | None) -> set:
    own = words(text)
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else ({tuple(own)} if own else set())


def components(rows: list[tuple]) -> dict:
    """The smallest id of each id's component; ids are unique."""
    sets = {row[0]: shingles(row[1]) for row in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def secrets(text: str | None) -> list[tuple[int, int, int]]:
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in SECRET.finditer(text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def held_out(doc_id, base: int, value: int) -> bool:
    return zlib.crc32(str(doc_id if doc_id is not None else "").encode()) % base == value


def base_scores(rows: list[tuple]) -> tuple[int, list[tuple]]:
    """Training tokens, and per row: held out, tokens, known tokens, score."""
    tokens = [words(row[1]) + [b""] for row in rows]
    held = [held_out(row[0], 5, 1) for row in rows]
    counts = Counter(word for own, out in zip(tokens, held) if not out for word in own)
    total, scale = counts.total(), counts.total() + 0.5 * (len(counts) + 1)
    scored = [
        (out, len(own), sum(counts[w] > 0 for w in own), sum(math.log10((counts[w] + 0.5) / scale) for w in own))
        for own, out in zip(tokens, held)
    ]
    return total, scored
