"""Plain Python twins of the operators, for small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import re

import xxhash

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return text.translate(ASCII_LOWER)


def warc(pages):
    """{index: (page_id, bytes, digest, type, refers_to)}; pages are (page_id, url, html)."""
    rows = [(p, u, (h or "").encode()) for p, u, h in pages]
    out = []
    for i, (p, u, h) in enumerate(rows):
        same = [(j, q, v) for j, (q, v, g) in enumerate(rows) if g == h]
        best = max(same, key=lambda x: (x[1] is not None, x[1] or 0, x[2] is not None, x[2] or "", -x[0]))
        digest = base64.b32encode(hashlib.sha1(h).digest()).decode()
        out.append((p, len(h), digest, "response" if best[0] == i else "revisit", None if best[0] == i else best[1]))
    return out


def decontaminate(docs, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (t := tuple(w[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    ids |= windows[t]
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


def line_dedup(docs, least=10):
    key = lambda x: lower(x.strip(" \t\n\v\f\r"))
    order = lambda d: (d is None, d or 0)
    first: dict[str, tuple] = {}
    for doc, text in docs:
        for x in (text or "").split("\n"):
            first[key(x)] = min(first.get(key(x), (True, math.inf)), order(doc))
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or first[key(x)] == order(doc)]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def topk(rows, k=10, divisor=100, scale=1024):
    fine = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in fine:
        if q % divisor == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q and len(b) == len(a))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return out


KINDS = (("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
          r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
         ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]+", 0, 32))


def base_secrets(text):
    found = [(m.start(), n, m.end(), kind) for n, (kind, p, g, least) in enumerate(KINDS)
             for m in re.finditer(p, text or "") if len(m.group(g)) >= least]
    return sorted(found)


def entropy_runs(word, bits, window=20):
    """Runs of characters in windows whose entropy is at least ``bits``, counted anew for each window."""
    hot = set()
    for i in range(len(word) - window + 1):
        w = word[i:i + window]
        h = -sum(w.count(c) / window * math.log2(w.count(c) / window) for c in set(w))
        if h >= bits - 1e-9:
            hot.update(range(i, i + window))
    runs = []
    for i in sorted(hot):
        if runs and runs[-1][1] == i:
            runs[-1] = (runs[-1][0], i + 1)
        else:
            runs.append((i, i + 1))
    return runs


def simhash(text, words=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not w:
        return 0
    k = min(words, len(w))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs, most=3):
    fps = [simhash(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                root[find(i)] = find(j)
    low: dict[int, int | None] = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        low[r] = d if low.get(r) is None else low[r] if d is None else min(d, low[r])
    return [(d, f"{fps[i]:016x}", low[find(i)]) for i, (d, _) in enumerate(docs)]


def chat(rows):
    """{conv: (n_turns, turns_sha, loss_chars, loss_sha)}; rows are (conv, turn, role, text)."""
    groups: dict = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(loss), sha(loss))
    return out
