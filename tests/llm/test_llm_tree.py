"""Sketches, the hash tree and spelling variants against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_fixtures import documents, empty, texts
from test_llm_duplicates import NULLS_LAST, similar_groups, varied
from test_llm_text import against_sql

from fleetpulse.llm import backoff, merkle, sketching, spelling
from fleetpulse.llm.common import Scratch


def near_by_hand(rows):
    return [(d, n, c, d is not None and d == c) for d, n, c in similar_groups(rows, 80, 2)]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_sketches_find_every_link(spark, seed):
    rows = varied(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = texts(sketching.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept")
    assert sorted(found) == sorted(near_by_hand(rows))


def test_sketches_of_odd_rows(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = sketching.near_duplicates(docs)
    assert sorted(texts(found, *found.columns), key=NULLS_LAST) == sorted(near_by_hand(rows), key=NULLS_LAST)
    against_sql(found, docs, sketching.SQL)
    assert sketching.near_duplicates(empty(spark)).count() == 0
    hollow = spark.createDataFrame([(1, None), (2, " \n"), (2, "")], "doc_id bigint, text string")
    assert sorted(texts(sketching.near_duplicates(hollow), *found.columns)) == [(1, 0, 1, True), (2, 0, 2, True), (2, 0, 2, True)]


def test_sketches_of_a_large_group_of_near_copies(spark):
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(base[: 20 + i % 3] + [f"x{i}"] + base[20 + i % 3 :])) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert set(texts(sketching.near_duplicates(df), "component_id")) == {(0,)}


def test_sketches_are_full_and_concentrated():
    draw = np.random.default_rng(2)
    errors = []
    for n in (1, 2, 3, 10, 200, 4000):
        whole = np.unique(draw.integers(0, 1 << 56, n, dtype=np.uint64))
        part = whole[: max(1, int(0.8 * len(whole)))]
        hashes, owners = np.concatenate([whole, part]), np.repeat([0, 1], [len(whole), len(part)])
        table = sketching.sketches(hashes, owners, 2)
        assert (table != sketching._EMPTY).all()
        errors.append(abs((table[0] == table[1]).mean() - len(part) / len(whole)))
        # what else is sketched at the same time changes nothing
        assert (sketching.sketches(part, np.zeros(len(part), np.int64), 1)[0] == table[1]).all()
    assert max(errors) < 0.08
    # a set that few rounds reach is filled by the rounds that are sure to
    lonely = sketching.sketches(np.array([7], np.uint64), np.zeros(1, np.int64), 1, bins=64)
    assert (lonely != sketching._EMPTY).all() and (lonely >> np.uint64(48)).max() >= 64


def tree_by_hand(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    low = lambda t: t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][k : k + 8])) for k in range(0, len(out[-1]), 8)])
        return out

    def climb(tree, at, digest):
        beside = ""
        for nodes in tree[:-1]:
            first = at - at % 8
            run = nodes[first : first + 8]
            beside += "".join(run[: at % 8] + run[at % 8 + 1 :])
            digest = sha("".join(run[: at % 8] + [digest] + run[at % 8 + 1 :]))
            at //= 8
        return digest, beside

    groups = {}
    for doc_id, source, lang, n, text in rows:
        leaf, other = (sha("".join(map(field, (doc_id, source, lang, n, t)))) for t in (text, low(text)))
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        groups.setdefault(lang, []).append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf, other if tampered else leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g])]) for g in names}
    crown = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for at, (_, doc_id, leaf, offered) in enumerate(sorted(groups[g])):
            digest, low_part = climb(trees[g], at, offered)
            digest, high_part = climb(crown, k, digest)
            root = crown[-1][0]
            out.append((doc_id, leaf, trees[g][-1][0], root, sha(low_part + high_part), digest, digest == root))
    return out


def test_manifest_equals_brute_force(spark):
    draw = random.Random(4)
    sizes = {None: 9, "": 1, "de": 8, "en": 1300, "fr": 512, "it": 513, "ÿ": 2, **{f"l{k}": k % 4 + 1 for k in range(10)}}
    rows, at = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            at += 1
            rows.append((at * 7 % 5003, draw.choice(["a", None]), lang, draw.choice([None, 3]), draw.choice([None, "", f"Text {at % 50} É", "ÄB" * 3])))
    rows += [rows[20], rows[20], (None, None, "de", None, None), (None, "s", "en", 1, "X")]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    found = merkle.manifest(df)
    assert sorted(texts(found, *found.columns), key=NULLS_LAST) == sorted(tree_by_hand(rows), key=NULLS_LAST)
    for few in ([(5, "a", "en", 1, "x")], [(3, "a", "en", 1, "Abc"), (4, "b", None, 2, "D")]):
        small = spark.createDataFrame(few, df.schema)
        assert sorted(texts(merkle.manifest(small), *found.columns)) == sorted(tree_by_hand(few))


def test_manifest_of_odd_rows(spark):
    docs = documents(spark).withColumnRenamed("score", "leaf").withColumnRenamed("block", "root")
    rows = [tuple(r[c] for c in merkle.FIELDS) for r in docs.collect()]
    found = merkle.manifest(docs)
    assert sorted(texts(found, *found.columns), key=NULLS_LAST) == sorted(tree_by_hand(rows), key=NULLS_LAST)
    assert merkle.manifest(empty(spark)).count() == 0
    # fewer rows than the tamper rule leaves out: what is not tampered with verifies
    assert {v for d, v in texts(found, "doc_id", "verified") if d is None or zlib.crc32(str(d).encode()) % 3} == {True}


def variants_by_hand(rows):
    import re

    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    forms, out = {}, []
    for w, n in words.items():
        around = sorted((-words[v], v) for v in words if near(w, v))
        forms[w] = (len(around), around[0] if around and -around[0][0] >= 5 * n else None)
    for w, (k, best) in forms.items():
        root = w
        while forms[root][1]:
            root = forms[root][1][1]
        out.append((w, best and best[1], root, words[w], k, best and -best[0]))
    return out


NAMES = ("word", "form", "root", "n", "n_near", "form_n")


@pytest.mark.parametrize("seed", [0, 1])
def test_spelling_variants_equal_brute_force(spark, seed):
    draw = random.Random(seed)
    letters = ["abé", "abcdefghÿÀÉ"][seed]
    words = ["".join(draw.choice(letters) for _ in range(draw.choice([5, 6, 6, 7, 8, 12, 31, 32, 33, 34, 70]))) for _ in range(60)]
    for _ in range(150):
        word = draw.choice(words)
        k = draw.randrange(len(word))
        words.append(word[:k] + draw.choice(["", draw.choice(letters), word[k] + draw.choice(letters), word[k] * 2]) + word[k + 1 :])
    rows = []
    for i in range(200):
        picked = [w for w in words for _ in range(draw.choice([0, 0, 0, 1, 1, 8]) if zlib.crc32(w.encode()) % 3 else draw.choice([0, 0, 0, 0, 0, 1]))]
        rows.append((i if i % 50 else None, draw.choice([" ", "1", ", "]).join(w.upper() if draw.random() < 0.1 else w for w in picked)))
    rows += [(9, None), (9, ""), (9, "..."), rows[5]]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, word int, at int")
    found = sorted(texts(spelling.group(df), *NAMES), key=NULLS_LAST)
    assert found == sorted(variants_by_hand(rows), key=NULLS_LAST)
    assert any(r[1] for r in found) and any(len(r[0]) > 33 and r[4] for r in found)


def test_spelling_variants_of_odd_rows(spark):
    docs = documents(spark, n=600)
    found = spelling.group(docs)
    against_sql(found, docs, spelling.SQL)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(texts(found, *NAMES), key=NULLS_LAST) == sorted(variants_by_hand(rows), key=NULLS_LAST)
    assert spelling.group(empty(spark)).count() == 0
    # a run of a million letters, five times, and the same with a letter more
    long = [(i, "ab" * 100_000 + ("" if i % 2 else "c")) for i in range(12)]
    pairs = {n: (near, len(form or "")) for _, form, _, n, near, _ in texts(spelling.group(spark.createDataFrame(long, "doc_id bigint, text string")), *NAMES)}
    assert pairs == {6: (1, 0)}


def test_chains_of_forms_end_at_one_root(spark):
    counts = {"aaaaaab": 5, "aaaaaa": 30, "aaaaac": 160, "aaaadc": 900, "zzzzzz": 7}
    text = " ".join(w for w, n in counts.items() for _ in range(n))
    number = next(i for i in range(10_000) if all(zlib.crc32(f"{i}:{w}".encode()) % 199 for w in counts))
    found = dict(texts(spelling.group(spark.createDataFrame([(number, text)], "doc_id bigint, text string")), "word", "root"))
    assert found == {**dict.fromkeys(counts, "aaaadc"), "zzzzzz": "zzzzzz"}


def test_scratch_of_one_scope_leaves_others_alone(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c e")], "doc_id bigint, text string")
    outside = backoff.score(docs)
    with Scratch(spark) as first:
        inside = backoff.score(docs)
        with Scratch(spark) as second:
            inner = backoff.score(docs)
    second.clear()
    assert inside.count() == 2
    first.clear()
    assert outside.count() == 2
    with pytest.raises(Exception, match="not exist|NOT_EXIST"):
        inner.count()
