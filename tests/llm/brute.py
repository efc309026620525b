"""Plain versions of the text operators, for small fixtures."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def words(text):
    return WORD.findall(text or "")


def fixture(seed=5, n=60):
    """(doc_id, text, lang, source, n_chars, kept): prose with copies, shared passages and odd rows.

    ``kept`` is a column of the input whose name clashes with an output column.
    """
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice(["th", "er", "on", "an", "re", "é", "ti"]) for _ in range(rnd.randint(1, 5))) for _ in range(300)]

    def prose(k):
        lines, out = k, []
        while lines > 0:
            m = min(lines, rnd.randint(3, 25))
            out.append(" ".join(rnd.choice(vocabulary) for _ in range(m)).capitalize() + ".")
            lines -= m
        return "\n".join(out)

    texts = [prose(rnd.randint(1, 200)) for _ in range(n)]
    passage = prose(70).replace("\n", " ")
    for i in range(n):
        if i % 6 == 1:
            texts[i] = texts[i // 2]
        elif i % 6 == 2:
            w = words(texts[i // 3])
            for _ in range(max(1, len(w) // 40)):
                w[rnd.randrange(len(w))] = "CHANGED"
            texts[i] = " ".join(w)
        elif i % 6 == 3:
            texts[i] = texts[i] + "\n" + passage + "\n" + prose(5)
        elif i % 6 == 4:
            # lines of another document, some of them changed a little
            texts[i] = "\n".join(line.replace("er", "re", 1) for line in texts[i - 1].split("\n")[:3]) + "\n" + prose(9)
    odd = [None, "", "  \n\t ", "one", "one two three four", "one two three four", "same " * 300, "same " * 301, "x\x0by\x0cz\r\nq", "\n\n"]
    rows = [(i * 7 % 1000 + (3 if i % 2 else 1000), t, ["en", "de", None][i % 3], "src0", 1, "k") for i, t in enumerate(texts + odd)]
    return rows


def shingles(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)])


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def similar(a, b, percent=75):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def near_duplicates(rows):
    """{doc_id: (n_shingles, component_id, kept)}; ids are distinct."""
    sets, union = {r[0]: shingles(r[1]) for r in rows}, Union()
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if similar(sets[a], sets[b]):
                union.join(a, b)
    return {d: (len(sets[d]), union.find(d), union.find(d) == d) for d in ids}


def char_set(line):
    line = line.translate({c: c + 32 for c in range(65, 91)})
    return frozenset(line[i : i + 5] for i in range(len(line) - 4)) or frozenset([line])


def dedup_lines(rows):
    """{doc_id: (text, removed)}; ids are distinct."""
    union, first, sets = Union(), {}, {}
    for doc, text, *_ in sorted(rows, key=lambda r: r[0]):
        for i, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\n\x0b\x0c\r")
            if line:
                first.setdefault(line, (doc, i))
                sets[line] = char_set(line)
    lines = sorted(first, key=first.get)
    rank = {line: i for i, line in enumerate(lines)}
    for i, a in enumerate(lines):
        union.find(i)
        for b in lines[:i]:
            if similar(sets[a], sets[b]):
                union.join(i, rank[b])
    out = {}
    for doc, text, *_ in rows:
        if text is None:
            out[doc] = (None, 0)
            continue
        kept = []
        all_lines = text.split("\n")
        for i, line in enumerate(all_lines):
            cut = line.strip(" \t\n\x0b\x0c\r")
            if not cut or first[lines[union.find(rank[cut])]] == (doc, i):
                kept.append(line)
        out[doc] = ("\n".join(kept), len(all_lines) - len(kept))
    return out


def remove_repeats(rows, size=50):
    """{doc_id: (n_words, n_removed, kept text)}; ids are distinct."""
    low = {}
    for doc, text, *_ in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            low[key] = min(low.get(key, doc), doc)
    out = {}
    for doc, text, *_ in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - size + 1):
            if low[tuple(w[i : i + size])] < doc:
                gone.update(range(i, i + size))
        out[doc] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def edit_distance_in(item, text):
    """Smallest edit distance of ``item`` to any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(last + (c != d), row[j] + 1, row[j - 1] + 1)
    return min(row)
