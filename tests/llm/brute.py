"""Plain re-statements of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

from barline.llm import suffix_dedup

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, at string, rid string"


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(x: bytes | str) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def frame(spark, docs, parts: int = 3):
    """Documents with extra columns whose names clash with those that operators use inside."""
    rows = [(i, t, "en" if k % 2 else "fr", f"s{k % 3}", len(t or ""), 0.5, "r", "a", "x") for k, (i, t) in enumerate(docs)]
    return spark.createDataFrame(rows, SHAPE).repartition(parts)


def corpus(seed: int = 5, n: int = 60) -> list[tuple[int, str]]:
    """Periodic texts, runs, copies, near copies, shared passages, accents, empty and null texts."""
    rnd, docs = random.Random(seed), []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            t = " ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 120)))
        elif kind == 1:
            t = " ".join(["a"] * rnd.randint(0, 60) + ["b"] + ["c", "d"] * rnd.randint(0, 30))
        elif kind == 2:
            t = "\t\n".join(rnd.choice("abcdéfgh") for _ in range(200))
        elif kind == 3:
            a, b = rnd.choice(docs)[1], rnd.choice(docs)[1]
            t = " ".join(a.split()[: rnd.randint(0, 80)] + [str(rnd.random())] * rnd.randint(0, 40) + b.split()[rnd.randint(0, 30) :])
        elif kind == 4:
            t = " ".join(str(rnd.random()) for _ in range(60)) + " " + rnd.choice(docs)[1]
        else:
            words = rnd.choice(docs)[1].split()
            if words:
                words[rnd.randrange(len(words))] = "NEW"
            t = " ".join(words)
        docs.append((i, t))
    return [*docs, (n, None), (n + 1, ""), (n + 2, "one"), (n + 3, docs[2][1])]


def substring(docs, width: int = 20):
    words = {i: (t or "").encode().split() for i, t in docs}
    seen: dict[tuple, tuple] = {}
    for i in sorted(words):
        for p in range(len(words[i]) - width + 1):
            seen.setdefault(tuple(words[i][p : p + width]), (i, p))
    out = {}
    for i, ws in words.items():
        gone = [False] * len(ws)
        for p in range(len(ws) - width + 1):
            if seen[tuple(ws[p : p + width])] < (i, p):
                gone[p : p + width] = [True] * width
        out[i] = (len(ws), sum(gone), sha(b" ".join(w for w, g in zip(ws, gone) if not g)))
    return out


def suffix(docs, length: int = 400):
    body = [(i, (t or "").encode()) for i, t in docs]
    count = Counter(b[p : p + length] for _, b in body for p in range(len(b) - length + 1))
    out = {}
    for i, b in body:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def shared_tuples(docs, passage: int):
    """Bytes in sampled strings that stand at another sample too."""
    v, cover = suffix_dedup.cover_for(passage)
    width, body, at = passage - v + 1, {i: (t or "").encode() for i, t in docs}, defaultdict(list)
    for i, b in body.items():
        for p in range(len(b) - width + 1):
            if p % v in cover:
                at[b[p : p + width]].append((i, p))
    gone = {i: bytearray(len(b)) for i, b in body.items()}
    for places in at.values():
        for i, p in places if len(places) > 1 else []:
            gone[i][p : p + width] = b"\1" * width
    return {i: sum(g) for i, g in gone.items()}


def shingles(text, width: int = 5):
    w = SPACE_WORD.findall(lower(text or ""))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}


def jaccard(docs):
    sets = {i: shingles(t) for i, t in docs}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def leaks(docs, items, window: int = 10):
    patterns = defaultdict(set)
    for item, text in items:
        w = ALNUM_WORD.findall(lower(text or ""))
        for p in range(max(len(w) - window + 1, 1 if w else 0)):
            patterns[tuple(w[p : p + window])].add(str(item))
    out = {}
    for i, text in docs:
        w, hit, found = ALNUM_WORD.findall(lower(text or "")), set(), set()
        for size in {len(p) for p in patterns}:
            for p in range(len(w) - size + 1):
                if (k := tuple(w[p : p + size])) in patterns:
                    hit |= set(range(p, p + size))
                    found |= patterns[k]
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def paragraphs(text: str) -> set[bytes]:
    return {x.strip(b" \t\n\r\x0b\x0c") for x in re.split(rb"(?<=\n)|(?<=[.!?])(?= )", text.encode())} - {b""}


def likeness(a: str, b: str) -> float:
    x, y = paragraphs(a), paragraphs(b)
    return len(x & y) / len(x | y) if x | y else 1.0
