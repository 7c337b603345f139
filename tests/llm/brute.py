"""Plain versions of the operators for small inputs, and inputs with every odd case."""

from __future__ import annotations

import math
import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns whose names the operators use inside.
CLASHING = ("score", "n_tokens", "size", "target", "taken", "label", "node", "bucket", "next", "sketch", "line",
            "component_id", "kept", "predicted", "key", "held_out")

WORDS = ("river stone cloud amber field lantern quiet morning harbor window paper silver garden winter bridge "
         "candle forest meadow copper thunder pillow market engine velvet island").split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def odd_docs() -> list[tuple]:
    rng = random.Random(5)
    a, b = sentence(rng, 60), sentence(rng, 45)
    near = a.split()
    near[30] = "changed"
    texts = [
        (1, a, "s1"), (2, None, "s1"), (3, "", "s2"), (4, " \n\t ", "s2"), (5, a, "s3"), (6, " ".join(near), None),
        (7, b + "\n" + sentence(rng, 4000) + "\n" + "x" * 70_000 + "\n" + b, "s1"), (None, a, "s1"), (None, None, None),
        (9, "one", "s4"), (10, "one two", "s4"), (11, "ONE Two", "s4"), (12, "日本語のテキスト ひらがな 漢字", "s5"),
        (13, "emoji 🎉 and nbsp  em  space", "s5"), (1, a, "s1"), (14, b + "\n" + b, "s6"), (15, b, "s6"),
    ]
    return [(i, t, "en", s, None if t is None else len(t)) for i, t, s in texts]


def frame(spark, rows: list[tuple], extra: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOCS)
    if extra:
        df = df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})
    return df


# --- near duplicates ---------------------------------------------------------
def shingle_set(text, width=3):
    raw = (text or "").encode()
    raw = re.sub(rb"[A-Z]", lambda m: m.group().lower(), raw)
    w = re.findall(rb"[^\x20\x09-\x0d]+", raw)
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def near_components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id, kept) by testing every pair."""
    sets = [shingle_set(r[1]) for r in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    head = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            head[root(i)] = min(head.get(root(i), r[0]), r[0])
    out = []
    for i, r in enumerate(rows):
        c = None if r[0] is None else head[root(i)]
        out.append((r[0], len(sets[i]), c, c is None or c == r[0]))
    return out


# --- lines -------------------------------------------------------------------
def edit_distance(a: str, b: str) -> int:
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def line_dedup(rows: list[tuple], edits=2, min_chars=20) -> list[tuple]:
    """(doc_id, text) with repeated lines taken out, testing every pair of lines."""
    first: dict[str, tuple] = {}
    for r in rows:
        if r[0] is not None and r[1] is not None:
            for k, line in enumerate(r[1].split("\n")):
                if line.strip(" \t\n\v\f\r"):
                    first[line] = min(first.get(line, (math.inf,)), (r[0], k))
    lines = list(first)
    group = {x: x for x in lines}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, x in enumerate(lines):
        for y in lines[:i]:
            if min(len(x), len(y)) >= min_chars and abs(len(x) - len(y)) <= edits and root(x) != root(y) and edit_distance(x, y) <= edits:
                group[root(x)] = root(y)
    head: dict[str, tuple] = {}
    for x in lines:
        head[root(x)] = min(head.get(root(x), (math.inf,)), first[x])
    out = []
    for r in rows:
        text = r[1]
        if r[0] is not None and text is not None:
            text = "\n".join(
                x for k, x in enumerate(text.split("\n")) if x not in group or head[root(x)] == (r[0], k)
            )
        out.append((r[0], text))
    return out


# --- mixing ------------------------------------------------------------------
def mix(rows: list[tuple]) -> list[tuple]:
    """(doc_id, size, source_size, target, taken) by dealing the excess out again and again."""
    import hashlib

    def size(t):
        return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))

    sources: dict = {}
    for r in rows:
        sources[r[3]] = sources.get(r[3], 0) + size(r[1])
    order = sorted(sources, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total = sum(sources.values())
    over: set = set()
    while True:
        left = 3 * total - 4 * sum(sources[s] for s in over)
        weights = sum(weight[s] for s in order if s not in over)
        more = {s for s in order if weight[s] * left > 4 * sources[s] * weights}
        if more == over:
            break
        over = more
    target = {
        s: 2.0 * sources[s] if s in over else float(weight[s]) * float(left) / float(2 * weights or 1) for s in order
    }
    out = []
    for r in rows:
        n, s = size(r[1]), r[3]
        rate = target[s] / sources[s] if sources[s] else 0.0
        name = "null" if r[0] is None else str(r[0])
        draw = int(hashlib.md5(f"mix-1|{name}".encode()).hexdigest()[:13], 16) / (1 << 52)
        taken = n * (math.floor(rate) + (draw < rate - math.floor(rate)))
        out.append((r[0], n, sources[s], target[s], taken))
    return out
