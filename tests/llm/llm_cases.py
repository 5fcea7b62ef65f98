"""Plain versions of the operators, and tables of awkward rows."""

from __future__ import annotations

import os
import random
import re
from collections import Counter, defaultdict

import duckdb

DOCS = "doc_id bigint, text string, lang string, source string, key string, n bigint, kept string, `a.b` string"
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))


def awkward(spark, extra=()):
    """Null, blank, very long, equal and repeated rows, and columns whose names clash."""
    rows = [
        (1, None, "en", "s"),
        (2, "", "en", "s"),
        (3, "  \n\t ", "en", None),
        (4, "One two", None, None),
        (5, "one TWO", "en", "s"),
        (5, "one TWO", "en", "s"),
        (None, "one two", "de", "s"),
        (None, None, None, None),
        (6, LONG, "en", "s"),
        (7, LONG + " end", "en", "t"),
        (8, "Ünïcode ÄÖ 漢字 \u0000 😀 é́ and so on for a while", "de", "t"),
        *extra,
    ]
    return spark.createDataFrame([(*r, "k", 1, "no", "dot") for r in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return [tuple(r) for r in df.collect()]


def oracle(sql, sf_dir, **tables):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.sql(f"create view {name.split('.')[0]} as select * from '{sf_dir}/{name}'")
    for name, table in tables.items():
        con.register(f"given_{name}", table)
        con.sql(f"create or replace view {name} as select * from given_{name}")
    return con.sql(sql)


def by_name(relation):
    """Rows as a bag, columns in order of their names."""
    order = sorted(relation.columns)
    return Counter(map(str, relation.select(*[f'"{c}"' for c in order]).fetchall()))


def spark_by_name(df):
    order = sorted(df.columns)
    return Counter(str(tuple(r)) for r in df.select(*[f"`{c}`" for c in order]).collect())


def folded(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", folded(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def near_groups(docs):
    """{(id, text): (set size, component, kept)} by comparing all pairs of different sets."""
    classes = defaultdict(list)
    for i, t in docs:
        classes[shingles(t)].append(i)
    sets = [s for s in classes if s]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].add(k)
    for k, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j < k}:
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                parent[root(k)] = root(j)
    smallest = {}
    for k, s in enumerate(sets):
        ids = [i for i in classes[s] if i is not None]
        old = smallest.get(root(k))
        smallest[root(k)] = min([*ids, *([] if old is None else [old])], default=None)
    place = {s: k for k, s in enumerate(sets)}
    out = {}
    for i, t in docs:
        s = shingles(t)
        component = smallest[root(place[s])] if s else i
        out[i, t] = (len(s), component, i == component)
    return out


def twins(n=2048):
    """Two words that every polynomial hash modulo 2**64 with an odd base confuses: their
    letters differ by the signs of the Thue-Morse sequence."""
    draw, signs = random.Random(9), [bin(i).count("1") % 2 for i in range(n)]
    letters = [97 + 2 * draw.randrange(13) for _ in signs]
    return "".join(chr(c + s) for c, s in zip(letters, signs)), "".join(chr(c + 1 - s) for c, s in zip(letters, signs))
