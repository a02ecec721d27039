"""Plain versions of the operators' contracts, for small inputs."""

import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def simhash(text, width=3):
    from xxhash import xxh64_intdigest

    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    grams = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, pairs):
    """Smallest node reachable from each of n nodes."""
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def simhash_classes(docs, radius=3):
    """Component of each (id, text); ids are unique."""
    docs = sorted(docs)
    prints = [simhash(t) for _, t in docs]
    near = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    return {docs[k][0]: (prints[k], docs[r][0]) for k, r in enumerate(components(len(docs), near))}


def cosine_classes(rows, threshold=0.95):
    """(links, component, kept) of each (id, vector); ids are unique."""
    rows = sorted(rows, key=lambda r: r[0])

    def good(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    def cos(a, b):
        a, b = np.array(a, float), np.array(b, float)
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    near = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if good(rows[i][1]) and good(rows[j][1]) and len(rows[i][1]) == len(rows[j][1]) and cos(rows[i][1], rows[j][1]) >= threshold
    ]
    roots = components(len(rows), near)
    degree = [sum(k in p for p in near) for k in range(len(rows))]
    return {rows[k][0]: (degree[k], rows[r][0], k == r) for k, r in enumerate(roots)}


def align(item, passage):
    """Best Smith-Waterman score over the item's length: match 1, mismatch and gap -0.5."""
    table = np.zeros((len(item) + 1, len(passage) + 1))
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (1 if a == b else -0.5), table[i - 1, j] - 0.5, table[i, j - 1] - 0.5)
    return table.max() / max(1, len(item))


def without_boilerplate(pages, ratio=0.1, min_pages=3, min_chars=1):
    """Text of each page (id, host, text) without its host's boilerplate lines; pages of equal text count once."""
    held, total = {}, {}
    for _, host, text in pages:
        if text is not None:
            total.setdefault(host, set()).add(text)
            for line in {x.strip(" ") for x in text.split("\n")} - {""}:
                held.setdefault((host, line), set()).add(text)

    def gone(host, line):
        n = len(held.get((host, line), ()))
        return host is not None and len(line) >= min_chars and n >= min_pages and n / len(total[host]) > ratio

    return {i: None if t is None else "\n".join(x for x in t.split("\n") if not gone(h, x.strip(" "))) for i, h, t in pages}
