"""Plain versions of the contracts, without Spark, for comparison."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def shingles(text):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < 5:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def near_duplicates(docs):
    """{doc_id: (n_shingles, component_id, kept)} for rows (doc_id, text) with distinct ids."""
    sets = {d: shingles(t) for d, t in docs}
    by_shingle = {}
    for d, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(d)
    common = Counter()
    for ds in by_shingle.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                common[a, b] += 1
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for (a, b), k in common.items():
        if 100 * k >= 85 * (len(sets[a]) + len(sets[b]) - k):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text, lower=False)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    inside = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


def base_spans(text):
    text = text or ""
    out = []
    for m in re.finditer(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text,
    ):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def secrets(text):
    """n_assign, n_access, n_hex, base_sha256, base spans."""
    spans = base_spans(text)
    kinds = Counter(s[3] for s in spans)
    joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
    return kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(joined.encode()).hexdigest(), joined


def unigram(docs):
    """{doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}."""
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in docs}
    tokens = {d: [*words(t), None] for d, t in docs}  # None: the end
    n = Counter(x for d, ts in tokens.items() if not held[d] for x in ts)
    total, kinds = sum(n.values()), len(n)
    return {
        d: (held[d], len(ts), sum(n[x] > 0 for x in ts), total, sum(math.log10((n[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in ts))
        for d, ts in tokens.items()
    }


def warc(pages):
    """{page_id: (payload_bytes, payload_digest, record_type, refers_to)}."""
    raw = {p: (h or "").encode() for p, h in pages}
    first = {}
    for p in sorted(raw):
        first.setdefault(raw[p], p)
    out = {}
    for p, data in raw.items():
        again = len(data) >= 100 and first[data] != p
        out[p] = (len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None)
    return out


def earliest_deadline_first(blocks, weights):
    """Slots of each stream's blocks: windows of all blocks from the fluid schedule, then the released block due first."""
    w = [Fraction(x) for x in weights]
    passed = lambda v: sum(min(Fraction(b), x * v) for b, x in zip(blocks, w, strict=True))
    waiting = [(math.ceil(passed((j + 1) / w[i])), i, j, math.floor(passed(j / w[i]))) for i in range(len(blocks)) for j in range(blocks[i])]
    slots = [[] for _ in blocks]
    for t in range(sum(blocks)):
        first = min(x for x in waiting if x[3] <= t)
        assert first[2] == len(slots[first[1]]) and t < first[0]
        slots[first[1]].append(t)
        waiting.remove(first)
    return slots


def kneser_ney(texts, letters, symbols, order=4):
    """Log-perplexity per text under interpolated modified Kneser-Ney of its characters' symbols; ASCII texts of one language."""
    found = Counter(c for t in texts.values() for c in t.lower() if c.isalpha())
    own = {c: i for i, (c, _) in enumerate(sorted(found.items(), key=lambda x: (-x[1], x[0]))[:letters])}
    other = lambda c: "digit" if c.isdigit() else "blank" if c.isspace() else "stop" if c in ".,;:!?'\"-()" else "mark"
    read = {d: ["blank"] * (order - 1) + [own.get(c, other(c)) for c in t.lower()] for d, t in texts.items()}
    counts = {order: Counter(tuple(s[i : i + order]) for s in read.values() for i in range(len(s) - order + 1))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cuts, totals, kinds = {}, {}, {}
    for n, held in counts.items():
        n1, n2, n3, n4 = (sum(c == k for c in held.values()) for k in (1, 2, 3, 4))
        d = [0.5, 0.75, 0.9]
        if min(n1, n2, n3, n4):
            y = n1 / (n1 + 2 * n2)
            d = [min(max(x, 0.05), k - 0.05) for k, x in enumerate((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3), 1)]
        cuts[n], totals[n], kinds[n] = d, Counter(), Counter()
        for g, c in held.items():
            totals[n][g[:-1]] += c
            kinds[n][g[:-1]] += d[min(c, 3) - 1]

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / symbols
        total, c = totals[n][gram[:-1]], counts[n][gram]
        if not total:
            return p(gram[1:])
        return (max(c - cuts[n][min(c, 3) - 1], 0) if c else 0) / total + kinds[n][gram[:-1]] / total * p(gram[1:])

    return {d: -sum(math.log(p(tuple(s[i : i + order]))) for i in range(len(s) - order + 1)) / (len(s) - order + 1) for d, s in read.items()}
