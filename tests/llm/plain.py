"""Plain versions of the operators, one row after the other, to test against."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def crc(ids: list[int]) -> int:
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def words(text: str | None) -> list[str]:
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def line_chunks(text: str) -> list[list[str]]:
    lines = text.split("\n")
    hashes = [0] + [int(hashlib.md5(line.encode()).hexdigest()[:8], 16) for line in lines]
    meets = [False] + [(hashes[i - 1] * 31 + hashes[i]) % 4 == 0 for i in range(1, len(hashes))]
    ends = [i for i in range(2, len(lines) - 1) if meets[i] and not meets[i - 1]] + [len(lines)]
    return [lines[a:b] for a, b in zip([0] + ends, ends)]


def line_dedup(docs: dict) -> dict:
    """doc_id -> (text, lines, removed lines)."""
    seen, out = set(), {}
    for i in sorted(docs):
        kept, lines, gone = [], 0, 0
        for chunk in line_chunks(docs[i]):
            lines += len(chunk)
            if len(chunk) >= 2 and tuple(chunk) in seen:
                gone += len(chunk)
            else:
                kept += ["\n".join(chunk)]
                seen.add(tuple(chunk))
        out[i] = ("\n".join(kept), lines, gone)
    return out


def benchmark_hits(docs: list, items: list, width: int = 10) -> list:
    """Per document (words, hit words, items, digest, contaminated)."""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for x in [tuple(w[i:i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [tuple(w)] if w else []:
            windows[x].add("null" if item is None else item)
    sizes, out = {len(x) for x in windows}, []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if x := windows.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    found |= x
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


def word_passages(docs: dict, width: int = 13) -> dict:
    """doc_id -> (words, removed, digest of what stays)."""
    split = {i: SPACED.findall(t) for i, t in docs.items()}
    first = {}
    for i in sorted(split):
        for k in range(len(split[i]) - width + 1):
            first.setdefault(tuple(split[i][k:k + width]), i)
    out = {}
    for i, w in split.items():
        gone = {j for k in range(len(w) - width + 1) if first[tuple(w[k:k + width])] < i for j in range(k, k + width)}
        out[i] = (len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def byte_strings(docs: dict, width: int = 100) -> dict:
    """doc_id -> (bytes, removed, spans, digest of what stays)."""
    seen, out = set(), {}
    for i in sorted(docs):
        raw = docs[i].encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - width + 1):
            piece = raw[k:k + width]
            if piece in seen:
                gone[k:k + width] = b"\1" * width
            seen.add(piece)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = (len(raw), sum(gone), spans, sha(bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def near_duplicates(docs: dict, threshold: float = 0.8) -> dict:
    """doc_id -> (class, size of the class, links, group)."""
    sets = {}
    for i, text in docs.items():
        w = words(text)
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset({i})
    classes = {}
    for i in sorted(sets):
        classes.setdefault(sets[i], []).append(i)
    heads = [(m[0], s) for s, m in classes.items()]
    links, parent = defaultdict(int), {i: i for i, _ in heads}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(heads):
        for j, t in heads[:a]:
            n = len(s & t)
            if n and n >= threshold * (len(s) + len(t) - n):
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (classes[s][0], len(classes[s]), links[classes[s][0]], find(classes[s][0])) for i, s in sets.items()}
