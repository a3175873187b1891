"""Plain re-statements of the operators' contracts, for small tables."""

import re
from collections import defaultdict

import xxhash

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TOKEN = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def fingerprint(text, k=3):
    ws = TOKEN.findall((text or "").translate(LOWER))
    if not ws:
        return 0
    sh = [" ".join(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def component_ids(rows, radius=2):
    """rows (id, fingerprint) -> the smallest id of each row's group."""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for d, f in rows:
        if d is not None:
            least[root(f)].append(d)
    return [min(least[root(f)], default=None) for _, f in rows]


def window_hits(text, items, n=10):
    """(hit words, sorted ids of the items found) for items {id: text}."""
    ws, hit, found = words(text), set(), set()
    for i, t in items.items():
        iw = words(t)
        wins = [iw[a:a + n] for a in range(max(1, len(iw) - n + 1))] if iw else []
        for w in wins:
            for a in range(len(ws) - len(w) + 1):
                if ws[a:a + len(w)] == w:
                    hit.update(range(a, a + len(w)))
                    found.add(str(i))
    return len(hit), sorted(found)


SECRET = [("assign", re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 8),
          ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile(r"[0-9a-f]+"), 0, 32)]


def secret_spans(text):
    """(start, kind number, end, value) of the base kinds."""
    return sorted((m.start(), k, m.end(), m[g]) for k, (_, p, g, n) in enumerate(SECRET)
                  for m in p.finditer(text or "") if len(m[g]) >= n)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(ds):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(ds))) % 10 == 0


def pii_spans(text):
    text = text or ""
    digits = lambda m: [c for c in m[0] if c in "0123456789"]
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out)
