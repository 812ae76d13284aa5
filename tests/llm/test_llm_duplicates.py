"""Similar documents, repeated passages and near vectors against brute force; the pipeline stage by stage."""

import hashlib
import random
import time
from pathlib import Path

import numpy as np
import pytest
from llm_fixtures import documents, empty, texts
from pyspark.sql import functions as F

import corpus_pipeline
from fleetpulse.llm import backoff, common, components, jaccard, neighbours, repeats, rules, suffixes
from fleetpulse.llm import shingles as shingle_module


def shingle_set(text, width=5):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < width else [tuple(words[k : k + width]) for k in range(len(words) - width + 1)])


def similar_groups(rows, percent=75, width=5):
    sets = [shingle_set(t, width) for _, t in rows]
    group = list(range(len(rows)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                group[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        known = [x for x in (least.get(top(k)), doc_id) if x is not None]
        least[top(k)] = min(known) if known else None
    return [(doc_id, len(sets[k]), least[top(k)]) for k, (doc_id, _) in enumerate(rows)]


def varied(seed, n=200):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range([8, 60, 3000][seed % 3])]
    rows = []
    for i in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.choice([0, 1, 4, 8, 12, 15, 25, 60, 200]))]
        if rows and draw.random() < 0.75:
            words = (draw.choice(rows)[1] or "").split()
            for _ in range(draw.choice([0, 1, 1, 2, 3, 6])):
                if words:
                    k = draw.randrange(len(words))
                    words[k : k + draw.choice([0, 1])] = draw.choice([[], [draw.choice(vocabulary)], [words[k].upper()]])
        rows.append((2 * i, draw.choice([" ", "\n", "\t "]).join(words) if draw.random() > 0.02 else None))
    return rows


NULLS_LAST = lambda r: tuple((v is None, v or 0) for v in r)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_jaccard_join_finds_every_link(spark, seed, monkeypatch):
    if seed == 1:  # several batches a task, no hub rounds
        monkeypatch.setattr(shingle_module, "HELD", 500)
        monkeypatch.setattr(jaccard, "ROUNDS", 0)
    rows = varied(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = texts(jaccard.joined(df), "doc_id", "n_shingles", "component_id")
    assert sorted(found) == sorted(similar_groups(rows))


def test_jaccard_join_of_odd_rows(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = texts(jaccard.joined(docs), "doc_id", "n_shingles", "component_id")
    assert sorted(found, key=NULLS_LAST) == sorted(similar_groups(rows), key=NULLS_LAST)
    assert jaccard.joined(empty(spark)).count() == 0


def test_signatures_meet_for_every_linked_pair():
    draw = np.random.default_rng(3)
    ends = jaccard.bands(75)
    for size in [1, 2, 3, 4, 5, 7, 9, 12, 16, 20, 33, 64, 150, 400]:
        for _ in range(30):
            one = np.unique(draw.integers(0, 1 << 56, size, dtype=np.uint64))
            two = one
            while True:  # as far apart as a link allows
                change = np.delete(two, draw.integers(len(two))) if draw.random() < 0.5 and len(two) > 1 else np.unique(np.append(two, draw.integers(0, 1 << 56, dtype=np.uint64)))
                common = len(np.intersect1d(one, change))
                if 100 * common < 75 * (len(one) + len(change) - common):
                    break
                two = change
            a, b = (jaccard.signatures(len(x), x, 75, ends) for x in (one, two))
            asked = set(a[0][a[2]].tolist()) & set(b[0][b[1]].tolist()) | set(b[0][b[2]].tolist()) & set(a[0][a[1]].tolist())
            assert asked


def test_texts_that_share_a_passage_alone_are_not_compared(spark, monkeypatch):
    draw = random.Random(5)
    word = lambda: f"w{draw.randrange(100_000)}"
    passage = " ".join(word() for _ in range(30))
    rows = []
    for _ in range(60):  # all have the passage, and each a copy, so that all its shingles are in two texts, and a near copy
        text = f"{' '.join(word() for _ in range(120))} {passage} {' '.join(word() for _ in range(120))}"
        rows += [text, text.replace(" ", "\n", 3), f"{text} {word()} {word()}"]
    rows = list(enumerate(rows))
    stored, homes = jaccard.stored, []

    def noted(df, name, *more):
        found = stored(df, name, *more)
        if name == "homes":
            homes.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "stored", noted)
    found = texts(jaccard.joined(spark.createDataFrame(rows, "doc_id bigint, text string")), "doc_id", "n_shingles", "component_id")
    assert sorted(found) == sorted(similar_groups(rows))
    assert homes == [0]


def test_stored_leaves_no_shuffle(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    shuffled = lambda: {x for x in env.blockManager().diskBlockManager().getAllBlocks().mkString(" ").split() if x.startswith("shuffle_")}
    before, setting = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    counts = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    found = common.stored(counts.join(counts.withColumnRenamed("count", "n"), "k"), "counts")
    limit = time.time() + 20
    while shuffled() - before and time.time() < limit:
        time.sleep(0.1)
    assert not shuffled() - before
    assert found.count() == 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100)], "a bigint, b bigint")
    found = dict(texts(components.components(links), "node", "component"))
    assert {found[i] for i in range(61)} == {0} and found[101] == 100


def cut_by_hand(rows, length):
    seen, out = set(), {}
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0)):
        raw = (rows[k][1] or "").encode()
        gone = [False] * len(raw)
        for s in range(len(raw) - length + 1):
            if raw[s : s + length] in seen:
                gone[s : s + length] = [True] * length
            seen.add(raw[s : s + length])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[k] = (rows[k][0], len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return list(out.values())


@pytest.mark.parametrize("length, gram, crowded, piece", [(100, 24, 20000, 1 << 20), (8, 3, 1, 64), (12, 4, 3, 1 << 20)])
def test_repeats_equal_brute_force(spark, monkeypatch, length, gram, crowded, piece):
    monkeypatch.setattr(repeats, "GRAM", gram)
    monkeypatch.setattr(repeats, "PIECE", piece)
    draw = random.Random(length + crowded)
    rows = []
    for i in range(120):
        letters = draw.choice(["ab", "abcdé ", "the quick brown\n"])
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 300)))
        if rows and draw.random() < 0.6:
            other = draw.choice(rows)[1] or ""
            a = draw.randint(0, len(other))
            text = text[: draw.randint(0, 50)] + other[a : a + draw.randint(0, 400)] + text[:20]
        rows.append((3 * i, None if draw.random() < 0.03 else text))
    rows += [(1000, "a" * 500), (1001, "xa" + "a" * 300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    # settings are module values: tasks of a local session read those of this process only if passed on
    found = repeats.remove_repeats(df, length=length, crowded=crowded)
    assert sorted(texts(found, *names)) == sorted(cut_by_hand(rows, length))


def test_repeats_of_odd_rows(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    key = lambda r: (r[0] is None, *[v or 0 for v in r[:4]], r[4])
    found = texts(repeats.remove_repeats(docs), *names)
    assert sorted(found, key=key) == sorted(cut_by_hand(rows, 100), key=key)
    assert repeats.remove_repeats(empty(spark)).count() == 0
    kept = repeats.without_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_suffix_array_and_common_prefixes():
    draw = random.Random(1)
    for _ in range(500):
        text = np.array([draw.randint(0, draw.choice([1, 2, 6])) for _ in range(draw.randint(1, 40))])
        plain = text.tolist()
        order = suffixes.suffix_array(text)
        assert order.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        found = suffixes.common_prefixes(text, order, 100)
        for one, two in zip(order[:-1], order[1:]):
            same = 0
            while max(one, two) + same < len(plain) and plain[one + same] == plain[two + same]:
                same += 1
            assert found[two] == same
        assert (suffixes.common_prefixes(text, order, 3) == np.minimum(found, 3)).all()


def nearest_by_hand(rows, every, k):
    good = {}
    for key, vector in rows:
        if key is not None and vector and all(x is not None and np.isfinite(x) for x in vector) and any(vector):
            good.setdefault(key, np.array(vector, dtype=float))
    out = {}
    for q, v in good.items():
        if q % every == 0:
            scores = [(-float(v @ w) / float(np.linalg.norm(v) * np.linalg.norm(w)), key) for key, w in good.items() if key != q and len(w) == len(v)]
            out[q] = [(key, -s) for s, key in sorted(scores)[:k]]
    return out


def test_neighbours_recall(spark):
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((20, 16)) * 3
    vectors = np.concatenate([draw.standard_normal((1500, 16)), centres[draw.integers(0, 20, 1500)] + draw.standard_normal((1500, 16))]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(5000, None), (5050, []), (5100, [0.0] * 16), (5150, [float("nan")] * 16), (5200, [None] * 16), (5250, [float("inf")] + [1.0] * 15), (None, [1.0] * 16), (5300, [1.0, 2.0]), (5301, [2.0, 4.0]), rows[7], rows[100]]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<float>, shard int, rank int")
    found = {}
    for r in sorted(neighbours.search(df, shard_rows=900, query_rows=40).collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    want = nearest_by_hand(rows, 50, 5)
    assert set(found) == set(want)
    hits = sum(len({k for k, _ in found[q]} & {k for k, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {q: dict(nearest_by_hand([(k, v) for k, v in rows if k in (q, *[x for x, _ in found[q]])], 1, 9)[q]) for q in list(found)[:10]}
    for q, near in exact.items():
        for key, score in found[q]:
            assert score == pytest.approx(near[key], abs=1e-12)
    assert found[5300] == [(5301, pytest.approx(1.0))]
    assert neighbours.search(df.limit(0)).count() == 0


def test_neighbours_ties_and_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (3, [2.0, 0.0]), (2, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    assert [(r["rank"], r["vec_id"], r["score"]) for r in neighbours.search(df).orderBy("rank").collect()] == [(1, 2, 1.0), (2, 3, 1.0), (3, 1, 0.0)]


def test_pipeline_stages(spark, tmp_path):
    docs = documents(spark, n=150).withColumn("_first", F.lit(7)).withColumn("_row", F.col("doc_id") + 7000)
    docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "near_duplicates", "repeated_passages", "source_mix", "packed_sequences"]

    def stage(name, frame):
        result = steps[name](spark, frame, str(tmp_path))
        result.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    first = stage("quality_rules", docs)
    verdicts = rules.judge(docs).filter("kept").select("doc_id")
    assert sorted(texts(first, "doc_id"), key=NULLS_LAST) == sorted(texts(verdicts, "doc_id"), key=NULLS_LAST)
    second = stage("near_duplicates", first)
    groups = similar_groups(texts(first, "doc_id", "text"))
    assert sorted(r["doc_id"] for r in second.collect() if r["doc_id"] is not None) == sorted({g for _, n, g in groups if n and g is not None} | {d for d, n, _ in groups if not n and d is not None})
    assert second.columns == docs.columns
    assert second.filter("NOT (_row <=> doc_id + 7000) OR _first <> 7").count() == 0
    third = stage("repeated_passages", second)
    want = cut_by_hand(texts(second, "doc_id", "text"), 100)
    assert third.count() == second.count()
    assert sum(len((t or "").encode()) for (t,) in texts(third, "text")) <= sum(w[1] - w[2] for w in want)
    assert all(n == len(t) for t, n in texts(third, "text", "n_chars"))
    fourth = stage("source_mix", third)
    assert fourth.columns == docs.columns and set(texts(fourth, "doc_id")) <= set(texts(third, "doc_id"))
    last = stage("packed_sequences", fourth)
    assert last.groupBy("doc_id").count().count() == fourth.groupBy("doc_id").count().count()
    assert last.filter("octet_length(ids) <> 4 * length OR crc32(ids) <> ids_crc32").count() == 0
    # one end id a document
    assert last.agg(F.sum(F.when(F.col("start") == 0, F.col("doc_tokens")))).first()[0] == last.agg(F.sum("length")).first()[0]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == last.count()
    hollow = spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, hollow, str(tmp_path)).count() == 0, name


def test_pipeline_keeps_the_result_of_one_stage(spark, tmp_path, monkeypatch):
    documents(spark).write.parquet(str(tmp_path / "in" / "documents.parquet"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(f"part{k}", lambda s, d, _, k=k: d.filter(F.col("doc_id") % 5 != k)) for k in range(4)])
    scratch = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    found = corpus_pipeline.run(spark, str(tmp_path / "in"))
    assert len([x for x in scratch.iterdir() if "-part" in x.name]) == 1
    assert sorted(found.select("doc_id").distinct().toPandas()["doc_id"] % 5) == sorted(
        documents(spark).filter("doc_id % 5 = 4").select("doc_id").distinct().toPandas()["doc_id"] % 5
    )


def test_backoff_of_large_batches(spark, monkeypatch):
    docs = documents(spark)
    whole = sorted(texts(backoff.score(docs), "doc_id", "log_score"), key=NULLS_LAST)
    assert sorted(texts(backoff.score(docs.repartition(5)), "doc_id", "log_score"), key=NULLS_LAST) == whole
