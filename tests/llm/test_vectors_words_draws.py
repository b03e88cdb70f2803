"""Vector duplicates, spelling groups and importance draws against brute force, and on edge rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from secflow.llm import importance, spelling_groups, vector_dedup

SF = "/root/testdata/sf0.001"


def _at_cosine(rng, v, cosine):
    v = v / np.linalg.norm(v)
    r = rng.standard_normal(len(v))
    r -= r @ v * v
    return cosine * v + math.sqrt(1 - cosine**2) * r / np.linalg.norm(r)


def _usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def _linked(rows, kind, cosine=0.95):
    """(id, links, component, kept) of every row, by comparing all pairs."""
    units = [np.array(v, kind).astype(float) if _usable(v) else None for _, v in rows]
    units = [None if u is None else u / np.linalg.norm(u) for u in units]
    near = [[j for j, b in enumerate(units) if i != j and a is not None and b is not None and len(a) == len(b) and a @ b >= cosine]
            for i, a in enumerate(units)]
    group, out = {}, []
    for i in range(len(rows)):
        if i not in group:
            todo, seen = [i], {i}
            while todo:
                for j in near[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
            group |= {j: least for j in seen}
        out.append((rows[i][0], len(near[i]), group[i], group[i] == rows[i][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "block"), [(512, 2048), (16, 32)])
def test_vector_links_equal_brute_force(spark, window, block):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((300, 24))
    vectors = [*base, *(_at_cosine(rng, base[i], 0.96) for i in range(0, 300, 6)),  # lone pairs
               *(_at_cosine(rng, base[1], 0.985) for _ in range(120)), *(_at_cosine(rng, base[2], 0.975) for _ in range(90)),  # rims and cores
               *[base[3]] * 70]
    chain = rng.standard_normal(24)
    for _ in range(60):  # each link of the chain holds, its ends are far apart
        vectors.append(chain)
        chain = _at_cosine(rng, chain, 0.96)
    rows = [(i * 7 - 500, v.tolist()) for i, v in enumerate(vectors)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_dedup.dedup_vectors(docs, window=window, block=block, target=0.9999).collect()), key=repr)
    assert found == _linked(rows, np.float64)


def test_vector_recall_with_small_windows(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((4000, 48))
    pairs = [_at_cosine(rng, v, rng.uniform(0.951, 0.96)) for v in base[:1000]]
    rows = [(i, v.tolist()) for i, v in enumerate([*base, *pairs])]
    out = vector_dedup.dedup_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), window=64, block=128)
    hit = out.where("n_links = 1 AND vec_id < 1000").count()
    assert hit >= 950 and out.where("n_links > 0").count() <= 2000


def test_vector_edges(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [(5, v), (5, v), (None, w), (9, w), (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 3.0]), (6, [1.0, float("nan"), 3.0]),
            (7, [1.0, float("inf"), 3.0]), (8, [1.0, 2.0, 3.0, 0.0]), (10, [-1.0, -2.0, -3.0]), (None, None), (None, [0.0, 1.0, 0.0]), (11, [1e30, 2e30, 3e30])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    docs = docs.withColumns({c: F.lit("clash") for c in ("node", "digest", "component", "vec", "n", "key", "place", "block", "ids")})
    out = vector_dedup.dedup_vectors(docs)
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect()), key=repr)
    assert found == _linked(rows, np.float32) and out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert vector_dedup.dedup_vectors(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        vector_dedup.dedup_vectors(docs, window=4096)


def test_passes_grow_with_the_table():
    passes = [vector_dedup.passes_for(n) for n in (100, 10**4, 10**6, 10**9)]
    assert passes == sorted(passes) and passes[0] == 1 and passes[-1] > passes[1]


def _runs(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[A-Za-zÀ-ÿ]+", low)


def _spelling(rows):
    times = Counter()
    for doc, text in rows:
        for run in _runs(text):
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            times[run] += 1
    n = {w: k for w, k in times.items() if len(w) >= 5 and k >= 3}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def _found(docs, **settings_):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_groups.group_spellings(docs, **settings_).collect()]


@pytest.mark.parametrize("symbols", [1, 3, 8])
def test_spelling_groups_equal_brute_force(spark, symbols):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abéz"), rng.integers(4, 8))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(words, 40, p=np.arange(1, 61) / 1830))) for i in range(40)]
    rows += [(100, "Straße STRASSE straße StraßE Àbcde àbcde"), (101, None), (102, ""), (None, "straße strasse " * 40), (None, "strasse " * 3),
             (103, "straBe" * 2000), (103, "straBe" * 2000), (104, "straBe" * 2000), (105, "strabe" * 2000 + "x " * 3), (106, "12 -- ß ÿÿÿÿÿ÷ ÿÿÿÿÿ÷ ÿÿÿÿÿ÷")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("word", "n", "key", "other", "form", "root")})
    if symbols == 1:  # everything of like length is a candidate
        docs, rows = docs.where("doc_id < 100"), rows[:40]
    found = _found(docs, symbols=symbols)
    assert set(found) == _spelling(rows) and len(found) == len(set(found))


def test_spelling_groups_of_the_table_and_of_none(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert set(_found(docs)) == _spelling([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert _found(docs.limit(0)) == [] and _found(docs.where("doc_id < 0")) == []


@given(st.lists(st.sampled_from("abcdé"), min_size=1, max_size=7), st.integers(1, 4))
@settings(max_examples=60, deadline=None)
def test_neighbourhood_holds_every_edit(letters, symbols):
    word = "".join(letters)
    keys = {int(k) for _, ks in spelling_groups.neighbour_keys(spelling_groups.reduced([word], symbols), symbols) for k in ks}
    edits = {word[:i] + word[i + 1:] for i in range(len(word))} | {word[:i] + c + word[i + d:] for i in range(len(word) + 1) for c in "abxé" for d in (0, 1)}
    for e in edits - {""}:
        assert int(spelling_groups.own_keys(spelling_groups.reduced([e], symbols))[0]) in keys


_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _grams(text):
    w = _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def _drawn(rows, target):
    grams = [_grams(t) for _, t in rows]
    s, t = Counter(b for _, g in grams for b in g), Counter(b for x in target for b in _grams(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for (doc, _), (words, g) in zip(rows, grams):
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in g)
        out.append([doc, words, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for i, r in enumerate(able[:5 * len(able) // 100]):
        r[5] = i + 1
    return sorted((tuple(r) for r in out), key=repr)


def _rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


def test_importance_draw_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    words = ["alpha", "Beta", "éçà", "x1", "7", "漢字", "𝒳y", "w" * 300, "İ"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 60)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "\0\0alpha\0beta\0"), (303, "- , ."), (None, "alpha beta " * 30), (5, rows[5][1]), (5, rows[5][1]), (304, "alpha beta " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs = docs.withColumns({c: F.lit("clash") for c in ("rank", "score", "weight", "place", "at", "less", "n_words", "counts")})
    target = spark.createDataFrame([("alpha beta x1",), (None,), ("",), ("alpha\0beta 7",)], "text string")
    assert _rows(importance.resample(docs, target)) == _drawn(rows, ["alpha beta x1", None, "", "alpha\0beta 7"])
    assert _rows(importance.resample(docs, target.limit(0))) == _drawn(rows, [])
    assert importance.resample(docs.limit(0), target).count() == 0


@given(st.lists(st.binary(max_size=70), min_size=1, max_size=8), st.binary(max_size=70))
@settings(max_examples=60, deadline=None)
def test_checksums_put_together(second, first):
    joined = importance.Shifts().joined(np.full(len(second), zlib.crc32(first), np.uint32), np.array([zlib.crc32(x) for x in second], np.uint32),
                                        np.array([len(x) for x in second]))
    assert joined.tolist() == [zlib.crc32(first + x) for x in second]


@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=12))
@settings(max_examples=60, deadline=None)
def test_no_gram_crosses_texts(texts):
    found = importance.Grams().of([(t or "").encode("utf-8", "replace") for t in texts]) if texts else None
    for i, t in enumerate(texts):
        words, grams = _grams((t or "").encode("utf-8", "replace").decode())
        assert found[0][i] == words and sorted(found[2][found[1] == i].tolist()) == sorted(grams)
