"""Plain versions of the operators on conversations and on spelling variants."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def conversations(rows):
    """{conv_id: [(role, text), ...]} of rows (conv_id, turn, role, text) with distinct turns."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [r[2:] for r in sorted(v, key=lambda r: r[:2])] for c, v in found.items()}


def chat(rows):
    """{conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)}."""
    out = {}
    for c, turns in conversations(rows).items():
        loss = "".join(text for role, text in turns if role == "assistant")
        out[c] = len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)), len(loss), sha(loss)
    return out


def trie(rows):
    """Sorted (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    own = conversations(r for r in rows if r[0] is not None)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
    below = defaultdict(list)
    for path in members:
        if path:
            below[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in below[path]) or 1
        n_words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        saved[path] = sum(saved[k] for k in below[path]) + (len(members[path]) - 1) * n_words
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(below[p]), leaves[p], saved[p], sha(",".join(str(c) for c in m if len(rebuilt[c]) == len(p))))
        for p, m in members.items()
    )


def word_counts(docs):
    """{word: n} of rows (doc_id, text)."""
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= 7:
                n[low] += 1
    return {w: k for w, k in n.items() if k >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(n):
    """Sorted (word, form, root, n, n_near, form_n) for {word: n}."""
    near = {a: [b for b in n if one_edit(a, b)] for a in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)
