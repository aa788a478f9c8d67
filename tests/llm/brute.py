"""Plain Python versions of the numbered operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingles(text, k=5):
    w = space_words((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def linked(rows):
    """[(doc_id, n_shingles, component)] in the order of rows; ids may be null or repeat."""
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in holders[x] if j > i)
        for j, n in both.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)].append(d)
    return [(rows[i][0], len(sets[i]), min(ids[find(i)], default=None)) for i in range(len(rows))]


def contamination(rows, items, window=13):
    by_length = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        w = plain_words(text)
        k = min(len(w), window)
        for i in range(len(w) - k + 1 if w else 0):
            by_length[k][tuple(w[i : i + k])].add(item)
    out = []
    for d, text in rows:
        w, hit, found = plain_words(text), set(), set()
        for k, windows in by_length.items():
            for i in range(len(w) - k + 1):
                own = windows.get(tuple(w[i : i + k]))
                if own:
                    hit.update(range(i, i + k))
                    found |= own
        ids = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def quality(rows):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    out = []
    for d, text in rows:
        w = space_words(text)
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        often = Counter(windows)
        hit = {j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 3)}
        lines = [x for x in (text or "").split("\n") if space_words(x)]
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        out.append((d, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit), failed))
    return out


def mix_targets(sizes, weights=(1, 2, 3), percent=100, most=3):
    """Target per source by sharing and resharing; sizes: {source: words}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget = sum(sizes.values()) * percent // 100
    capped = set()
    while True:
        left = budget - sum(most * sizes[s] for s in capped)
        base = sum(weight[s] for s in order if s not in capped)
        new = {s for s in order if s not in capped and most * sizes[s] * base <= left * weight[s]}
        if not new:
            return {s: float(most * sizes[s]) if s in capped else left * weight[s] / base for s in order}
        capped |= new


def removed_lines(rows, percent=80, k=1):
    """{(doc_id, line)} with an earlier line of similar k-word shingles, a line of fewer words taken whole; rows: (doc_id, text), ids apart."""
    lines = []
    for d, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for i, line in enumerate((text or "").split("\n")):
            w = space_words(line.lower())
            if w:
                lines.append(((d, i), {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))}))
    holders, out = defaultdict(list), set()
    for at_line, (at, s) in enumerate(lines):
        both = Counter(j for w in s for j in holders[w])
        if any(100 * n >= percent * (len(s) + len(lines[j][1]) - n) for j, n in both.items()):
            out.add(at)
        for w in s:
            holders[w].append(at_line)
    return out


BASE_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in double) % 10 == 0


def base_spans(text):
    out = []
    for kind, regex in BASE_KINDS.items():
        for m in re.finditer(regex, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 16 <= len(d) <= 19 and _luhn(d),
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }
            if fits[kind]():
                out.append((kind, m.start(), m.end()))
    return out


def personal(rows):
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256)."""
    out = []
    for d, text in rows:
        spans = base_spans(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = [sum(s[0] == k for s in spans) for k in BASE_KINDS]
        out.append((d, *counts, hashlib.sha256(joined.encode()).hexdigest()))
    return out


PHRASE_LABELS = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


def license_base(rows):
    """(doc_id, n_words, n_base, first_word, last_word, base_labels)."""
    out = []
    for d, text in rows:
        w = plain_words(text)
        places = [(i, label) for p, label in PHRASE_LABELS for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        at = [i for i, _ in places]
        out.append((d, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    return out


def archived(rows):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to); rows: (page_id, html)."""
    import base64

    payloads = [(p, (h or "").encode()) for p, h in rows]
    groups = defaultdict(list)
    for p, x in payloads:
        groups[x].append(p)
    out = []
    for p, x in payloads:
        known = [i for i in groups[x] if i is not None]
        keeper = max(known, default=None)
        revisit = keeper is not None and p != keeper
        digest = base64.b32encode(hashlib.sha1(x).digest()).decode()
        out.append((p, len(x), digest, "revisit" if revisit else "response", keeper if revisit else None))
    return out
