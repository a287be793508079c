"""Plain, slow versions that the operators are compared with."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

#: Texts that every text operator must survive.
ODD = [None, "", "   \n\t ", "One.", "one two", "a b c", "Héllo, wörld's I'M <|endoftext|>x <|startoftext|>", "a\x1cb c\x85d \xa0e  f",
       "1" * 3000, "x" * 5000, "For " * 2000, "日本語 テスト 🙂👍🏽", "ΑΣ ΟΔΟΣ ß ﬁ é", "mail a@b.c_d@e.f.g now", "+1 (377) 555-0271, 4111 1111 1111 1111",
       "1.2.3.4.5.6.7.8 256.1.1.1", "one two", "tab\tnew\r\nend  "]


def odd_documents(spark):
    """ODD with ids, a repeated row, a null id, a repeated id and columns with clashing names."""
    rows = [(k, t, "en", "s", k) for k, t in enumerate(ODD)]
    rows += [rows[5], (None, "one two", "de", "s", 0), (None, None, None, None, None), (3, "another text", "fr", None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, fp long").selectExpr(
        "doc_id", "text", "lang", "source", "fp", "fp as root", "fp as ids", "fp as part", "fp as rank", "fp as score", "fp as m", "fp as h", "fp as best", "fp as pii")


def simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "").encode())
    shingles = [b" ".join(words[k: k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    ones = Counter(b for s in shingles for h in [xxhash.xxh64_intdigest(s, 42)] for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def near_classes(rows, radius=3):
    """doc_id -> (fingerprint, component id) by comparing all pairs."""
    ids = sorted(i for i, _ in rows)
    texts = dict(rows)
    fps = np.array([simhash(texts[i]) for i in ids], np.uint64)
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps[k] ^ fps[k + 1:]) <= radius):
            a, b = find(k), find(k + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    return {ids[k]: (f"{int(fps[k]):016x}", ids[find(k)]) for k in range(len(ids))}


def repeated_bytes(texts, width=200):
    """(bytes, removed, spans, sha256 of the rest) of each text, by counting all strings."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k: k + width] for d in data for k in range(len(d) - width + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for k in range(len(d) - width + 1):
            if seen[d[k: k + width]] > 1:
                covered[k: k + width] = b"\1" * width
        rest = bytes(b for b, c in zip(d, covered) if not c)
        runs = sum(c and not (k and covered[k - 1]) for k, c in enumerate(covered))
        out.append((len(d), sum(covered), runs, hashlib.sha256(rest).hexdigest()))
    return out


_BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    def fine(kind, match):
        digits = re.sub("[^0-9]", "", match)
        return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in match.split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and _luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()

    return [(kind, m.start(), m.end()) for kind in _BASE for m in re.finditer(_BASE[kind], text or "") if fine(kind, m[0])]


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def line_dedup(rows, least=10):
    """(doc_id, n_lines, n_dropped, kept) of (doc_id, text) rows; a null id comes last."""
    def key(line):
        return line.strip(" \t\n\r\x0b\x0c").translate(_LOWER)

    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add((i is None, i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(key(x)) < least or min(holders[key(x)], key=lambda h: (h[0], h[1] or 0)) == (i is None, i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def ranked(docs, items, k=50):
    """(item_id, rank, doc_id, score); items is a dict of texts."""
    import math

    def cut(t):
        return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate(_LOWER))

    bags = [(i, Counter(cut(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    total, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items.items():
        asked = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) for t in set(cut(text)) if t in df}
        scores = [(sum(w * (10**9 * b[t] // (1000 * b[t] + 20 * (50 + 50 * n * total // length))) for t, w in asked.items() if t in b), i) for i, b, n in bags]
        best = sorted((-s, i is None, i or 0) for s, i in scores if s > 0)[:k]
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(best)]
    return out


def collocations(rows, top, least=100, longest=5):
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(_LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            counts.update((lang or "und", tuple(words[s: s + k])) for k in range(1, longest + 1) for s in range(len(words) - k + 1))
    found = {g: a for g, a in counts.items() if a >= least and len(g[1]) > 1}
    covered = Counter()
    for (lang, words), a in found.items():
        for k in range(2, len(words)):
            for s in range(len(words) - k + 1):
                covered[lang, words[s: s + k]] = max(covered[lang, words[s: s + k]], a)
    out = []
    for lang in totals:
        rest = []
        for (g_lang, w), a in found.items():
            if g_lang == lang and covered[lang, w] < a:
                cuts = [(1000 * a * totals[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                rest.append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
        out += [(lang, n + 1, p.decode(), -a, left, right, totals[lang], -s) for n, (s, a, p, left, right) in enumerate(sorted(rest)[:top])]
    return out
