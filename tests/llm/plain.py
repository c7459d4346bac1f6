"""Plain versions of the operators, word by word and pair by pair."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import types as T

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Columns of `documents`, and extra ones whose names the operators use themselves.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("node", T.StringType()),
        T.StructField("piece_ids", T.StringType()),
        T.StructField("_text_key", T.StringType()),
        T.StructField("score", T.StringType()),
    ]
)


def documents(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, source) as a table with clashing extra names."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "src", len(r[1] or ""), "a", "b", "c", "d")
        for r in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words(text, pattern):
    return pattern.findall(lowered(text))


def shingles(text, size):
    w = words(text, SPACED)
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()


def components(rows, size=4, percent=85):
    """(doc_id, set size, component) in the order of the rows."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders: dict = {}
    for i, own in enumerate(sets):
        overlap = Counter(j for s in own for j in holders.get(s, ()))
        for j, n in overlap.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for s in own:
            holders.setdefault(s, []).append(i)
    least: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    return [(d, len(sets[i]), min(least[find(i)])) for i, (d, _) in enumerate(rows)]


def contamination(rows, items, size=10):
    windows: dict = {}
    for item, text in items:
        w = words(text, ALNUM)
        for i in range(max(len(w) - size + 1, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text, ALNUM), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    found |= windows[tuple(w[i : i + n])]
                    hit |= set(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def _luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def personal(text):
    """Base spans (start, kind, end), by the rules as they are written."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def held_out(doc_id, modulus, rest):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == rest


def base_scores(rows):
    """doc_id -> (n_tokens, n_known, train_tokens, base_score)."""
    tokens = [(d, [*words(t, SPACED), None]) for d, t in rows]
    count = Counter()
    for d, own in tokens:
        if d is not None and not held_out(d, 7, 2):
            count.update(own)
    total, kinds = sum(count.values()), len(count)
    return {
        d: (
            len(own),
            sum(count[w] > 0 for w in own),
            total,
            sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in own),
        )
        for d, own in tokens
    }


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    """Leaf of a row's values in their order."""
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_levels(nodes, fan=16):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([digest("".join(low[i : i + fan])) for i in range(0, len(low), fan)])
    return levels


def proof(levels, i, fan=16):
    """(left, right) siblings of node i, level by level."""
    steps = []
    for low in levels[:-1]:
        begin = i // fan * fan
        steps.append(("".join(low[begin:i]), "".join(low[i + 1 : begin + fan])))
        i //= fan
    return steps


def merkle(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the columns of operator 11."""
    order = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, leaf(r)))
    sources: dict = {}
    for r in order:
        sources.setdefault(r[1], []).append(r)
    trees = [tree_levels([leaf(r) for r in own]) for own in sources.values()]
    whole = tree_levels([t[-1][0] for t in trees]) if trees else []
    out = []
    for k, own in enumerate(sources.values()):
        for i, r in enumerate(own):
            steps = proof(trees[k], i) + proof(whole, k)
            changed = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                changed = (*r[:4], lowered(r[4]))
            node = leaf(changed)
            for left, right in steps:
                node = digest(left + node + right)
            root = whole[-1][0]
            siblings = digest("".join(left + right for left, right in steps))
            out.append((r[0], leaf(r), trees[k][-1][0], root, siblings, node, node == root))
    return out


def alignment(rows, aligner):
    """Columns of operator 13, every whole text tokenised at once and by itself."""
    per, links = [], Counter()
    for doc_id, text in rows:
        own, groups, n_a, n_b = [], [], 0, 0
        if text:
            a = aligner.a.encode(" " + text, add_special_tokens=False).ids
            b = aligner.b.encode(text)
            bytes_a, bytes_b = [aligner.bytes_a[i] for i in a], [aligner.bytes_b[i] for i in b]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                n_a, n_b = len(a), len(b)
                ends_a, ends_b = _ends(bytes_a), _ends(bytes_b)
                x = y = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    i, j = ends_a[end] + 1, ends_b[end] + 1
                    own.append((a[i - 1], b[j - 1]))
                    groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
                    x, y = i, j
        links.update(own)
        per.append((doc_id, n_a, n_b, groups, own))
    top: Counter = Counter()
    for (_, b), n in links.items():
        top[b] = max(top[b], n)
    return [
        (d, n_a, n_b, len(g), len(own), sum(links[x] == top[x[1]] for x in own), sum(links[x] for x in own),
         digest(";".join(g)) if g else "")
        for d, n_a, n_b, g, own in per
    ]


def _ends(parts):
    out, at = {}, 0
    for k, part in enumerate(parts):
        at += len(part)
        out[at] = k
    return out
