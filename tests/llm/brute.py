"""What the operators should return, computed plainly in Python on small tables."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(sf: str, name: str) -> list[dict]:
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _luhn(d: str) -> bool:
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def pii_base(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    tests = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and _luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    return [(k, *m.span()) for k, p, ok in tests for m in re.finditer(p, text) if ok(m.group())]


def secret_base(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    tests = [
        ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         lambda m: len(m[2]) >= 12),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
    ]
    found = [(m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(tests) for m in re.finditer(p, text, re.A) if ok(m)]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def spans(found) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def op1(docs):
    out = {}
    for d in docs:
        f = pii_base(d["text"])
        out[d["doc_id"]] = (*(sum(k == x for k, _, _ in f) for x in ("email", "ip", "card", "phone")), _sha(spans(f)))
    return out


def op10(docs):
    out = {}
    for d in docs:
        f = secret_base(d["text"])
        out[d["doc_id"]] = (*(sum(k == x for k, _, _ in f) for x in ("assign", "access", "hex")), _sha(spans(f)))
    return out


def measures(text: str | None):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i:i + 5])].append(i)
    hit = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def crc(ids) -> int:
    return zlib.crc32(b"".join(struct.pack("<I", i) for i in ids))


def op2(docs, tokenizer, capacity=2048):
    out = {}
    for d in docs:
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out[d["doc_id"], n] = (at, len(part), crc(part))
    return out


def op5(docs, tokenizer):
    out, start = {}, 0
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        out[d["doc_id"]] = (start, len(ids), crc(ids))
        start += len(ids)
    return out


def op6(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["conv_id"]].append(r)
    said = "</s>[INST] ok [/INST]"
    by[-1] = [{"turn": 0, "role": "user", "text": said}, {"turn": 1, "role": "assistant", "text": said}]
    out = {}
    for c, turns in by.items():
        turns.sort(key=lambda r: r["turn"])
        loss = "".join(r["text"] or "" for r in turns if r["role"] == "assistant")
        out[c] = (len(turns), _sha("".join(f"{r['role']}\n{r['text'] or ''}\n" for r in turns)), len(loss), _sha(loss))
    return out


def classes_of(nodes, links):
    """Smallest node reachable from each."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def op4(rows, similarity=0.98):
    ok = [r for r in rows if r["label"] is not None and r["embedding"] and None not in r["embedding"]
          and np.isfinite(r["embedding"]).all() and np.any(r["embedding"])]
    links, count = [], defaultdict(int)
    for label in {(r["label"], len(r["embedding"])) for r in ok}:
        own = [r for r in ok if (r["label"], len(r["embedding"])) == label]
        x = np.array([r["embedding"] for r in own], float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for i, j in np.argwhere(np.triu(x @ x.T >= similarity, 1)):
            a, b = own[i]["vec_id"], own[j]["vec_id"]
            links.append((a, b))
            count[a] += 1
            count[b] += 1
    component = classes_of([r["vec_id"] for r in rows], links)
    return {v: (count[v], component[v], v == component[v]) for v in component}


def shingle_set(text: str | None) -> frozenset:
    words = WORD.findall(text or "")
    return frozenset(tuple(words[i:i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def op8(docs, similarity=0.8):
    sets = {d["doc_id"]: shingle_set(d["text"]) for d in docs}
    by = defaultdict(list)
    for n, s in sets.items():
        for x in s:
            by[x].append(n)
    shared = defaultdict(int)
    for group in by.values():
        for i, a in enumerate(group):
            for b in group[i + 1:]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), n in shared.items() if n >= similarity * (len(sets[a]) + len(sets[b]) - n)]
    return classes_of(sets, links)


def votes(text: str | None) -> list[int]:
    """Each quality rule's vote on a text, in the order of the operator's rules."""
    t = text or ""
    n, chars, symbols, dups, repeats = measures(text)
    words, size = max(n, 1), max(chars, 1)
    lines = sum(1 for line in t.split("\n") if WORD.search(line))
    runs = len(re.findall(r"[#*$%&|<>]+", t)) / words
    upper, shouts = len(re.findall("[A-Z]", t)) / size, t.count("!") / words
    ends = len(re.findall(r"[.?!](?=[ \t-\r]|$)", t)) / words
    mean, dup = chars / words, dups / max(lines, 1)

    def vote(bad: bool, good: bool) -> int:
        return -1 if bad else int(good)

    return [
        vote(n < 10, n >= 40), vote(mean < 2 or mean > 15, 3 <= mean <= 11), vote(symbols / words > 0.1, symbols / words <= 0.02),
        vote(runs > 0.1, runs <= 0.02), vote(dup > 0.3, dups == 0 and lines > 1), vote(repeats / words > 0.2, repeats / words <= 0.05),
        vote(upper > 0.4, upper <= 0.15), vote(shouts > 0.3, shouts <= 0.05), vote(n >= 30 and ends < 0.004, 0.02 <= ends <= 0.25)]


def op3(texts: list[str | None], pseudo: float = 10.0) -> list[float]:
    """Posterior chance of each text to be good, by expectation-maximisation over texts, not over patterns."""
    v = np.array([votes(t) for t in texts]) + 1
    hot = np.eye(3)[v]
    start = np.array([0.01, 0.19, 0.8]), np.array([0.3, 0.1, 0.6])
    good, sides = 0.8, [np.tile(s, (v.shape[1], 1)) for s in start]
    for turn in range(41):
        odds = np.log(good / (1 - good)) + (hot * (np.log(sides[0]) - np.log(sides[1]))).sum(axis=(1, 2))
        q = 1 / (1 + np.exp(-odds))
        if turn == 40:
            break
        new = [(np.einsum("t,trv->rv", w, hot) + pseudo * s) / (w.sum() + pseudo) for w, s in zip((q, 1 - q), start)]
        new[0][:, 0] = np.minimum(new[0][:, 0], 0.02)
        new[0] /= new[0].sum(axis=1, keepdims=True)
        share = min(max(q.mean(), 0.01), 0.99)
        moved = max(abs(share - good), *(np.abs(a - b).max() for a, b in zip(new, sides)))
        good, sides = share, new
        if moved < 1e-4:
            odds = np.log(good / (1 - good)) + (hot * (np.log(sides[0]) - np.log(sides[1]))).sum(axis=(1, 2))
            return list(1 / (1 + np.exp(-odds)))
    return list(q)
