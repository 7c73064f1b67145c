"""Plain, slow versions of the operators, from their definitions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

LATE = 1 << 63
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def without_repeats(rows, window=13):
    """(doc_id, n_words, n_removed, kept_sha256) of each (doc_id, text)."""
    first = {}
    split = [(LATE if i is None else i, words(t)) for i, t in rows]
    for i, ws in split:
        for j in range(len(ws) - window + 1):
            key = tuple(ws[j : j + window])
            first[key] = min(first.get(key, LATE), i)
    out = []
    for (doc_id, _), (i, ws) in zip(rows, split):
        gone = [False] * len(ws)
        for j in range(len(ws) - window + 1):
            if first[tuple(ws[j : j + window])] < i:
                gone[j : j + window] = [True] * window
        kept = " ".join(w for w, g in zip(ws, gone) if not g)
        out.append((doc_id, len(ws), sum(gone), sha(kept)))
    return out


def copies(rows):
    """(doc_id, keep_id, group_size, text_sha256) of each (doc_id, text)."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[sha((t or "").translate(FOLD))].append(i)
    keep = {h: max((i for i in ids if i is not None), default=None) for h, ids in groups.items()}
    return [(i, keep[h], len(groups[h]), h) for h, ids in groups.items() for i in ids]


def fingerprint(text):
    ws = words((text or "").translate(FOLD))
    shingles = [" ".join(ws[j : j + 3]) for j in range(max(1, len(ws) - 2))] if ws else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def connected(values, linked):
    """The smallest index that each one is connected with."""
    root = list(range(len(values)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(values)):
        for b in range(a):
            if linked(values[a], values[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(a) for a in range(len(values))]


def near_copies(rows):
    """(doc_id, fingerprint, component_id) of each (doc_id, text)."""
    marks = [fingerprint(t) for _, t in rows]
    roots = connected(marks, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(x for x in (least.get(r), i, LATE) if x is not None)
    return [
        (i, f"{m:016x}", None if least[r] == LATE else least[r]) for (i, _), m, r in zip(rows, marks, roots)
    ]


def targets(sizes, weights=(5, 2, 1), most=3):
    """source -> target: shares by weight, capped ones settled one round after another."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] > most * sizes[s] * total}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal_data(text):
    """(numbers of spans by kind, digest of the base spans, base spans)."""
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            valid = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if valid:
                found.append((m.start(), order, kind, f"{kind}:{m.start()}:{m.end()}"))
    found.sort()
    spans = [x[3] for x in found]
    return [sum(x[2] == k for x in found) for k in PATTERNS], sha(",".join(spans)), spans


def nearest(ids, vectors, i, k=20):
    """(vec_id, score) of row i's nearest other ids."""
    scores = vectors @ vectors[i]
    order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]]
    return [(int(ids[j]), float(scores[j])) for j in order[:k]]


def measures(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    text = text or ""
    ws = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(ws[j : j + 3]) for j in range(len(ws) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {j + k for j, w in enumerate(windows) if w in twice for k in range(3)}
    return (
        len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)
    )


def label_model(votes, bad_share=0.2, caught=0.3, cleared=0.95, prior=10.0, rounds=500):
    """Quality of each row of votes (-1 bad, 0 abstains, 1 good), row by row and rule by rule."""
    width = len(votes[0])
    hit, clear, share = [caught] * width, [cleared] * width, bad_share

    def quality(row):
        good, bad = math.log(1 - share), math.log(share)
        for v, a, b in zip(row, hit, clear):
            if v and a + b > 1:
                good += math.log(b if v > 0 else 1 - b)
                bad += math.log(1 - a if v > 0 else a)
        return 1 / (1 + math.exp(bad - good))

    for _ in range(rounds):
        q = [quality(row) for row in votes]
        old = [*hit, *clear, share]
        new_hit, new_clear = [], []
        for j in range(width):
            bad_votes = sum(1 - p for p, row in zip(q, votes) if row[j] < 0)
            bad_all = sum(1 - p for p, row in zip(q, votes) if row[j])
            good_votes = sum(p for p, row in zip(q, votes) if row[j] > 0)
            good_all = sum(p for p, row in zip(q, votes) if row[j])
            new_hit.append((prior * caught + bad_votes) / (prior + bad_all))
            new_clear.append((prior * cleared + good_votes) / (prior + good_all))
        share = (prior * bad_share + sum(1 - p for p in q)) / (prior + len(q))
        hit, clear = new_hit, new_clear
        if max(abs(a - b) for a, b in zip(old, [*hit, *clear, share])) < 1e-10:
            break
    return [quality(row) for row in votes]


def fill_in_middle(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if text == "" or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def one_edit(a, b):
    """Whether one inserted, deleted or replaced character leads from a to b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants(counts, times=5):
    """(word, form, root, n, n_near, form_n) of each word of a {word: n}."""
    form, near_count = {}, {}
    for w, n in counts.items():
        near = [x for x in counts if abs(len(x) - len(w)) < 2 and one_edit(w, x)]
        near_count[w] = len(near)
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= times * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return [(w, form[w], root(w), n, near_count[w], counts.get(form[w])) for w, n in counts.items()]


def spellings(rows, least=5, spared=199):
    """{word: n} of all (doc_id, text)."""
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % spared == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}
