"""Scores, rules and licenses against SQL and held-out labels."""

import math
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from llm_fixtures import documents, empty, texts
from pyspark.sql import functions as F

from fleetpulse.llm import backoff, licenses, quality, rules


def against_sql(df, docs, sql):
    documents = docs.select("doc_id", "text", "lang", "source").toPandas()  # noqa: F841  read by the SQL
    con = duckdb.connect(config={"memory_limit": "8GB"})
    con.register("documents", documents.astype({"doc_id": "Int64"}))
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = result.fetchall()
    assert sorted(names) == sorted(df.columns)
    key = lambda row: tuple((v is None, 0 if v is None else v) for v in row)
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=key)
    want = sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b) if all(v is None or isinstance(v, (int, float)) for v in a) else a == b


def test_backoff_equals_sql(spark):
    docs = documents(spark)
    against_sql(backoff.score(docs), docs, backoff.SQL)
    assert backoff.score(empty(spark)).count() == 0


def test_backoff_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b d"), (3, None)], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in backoff.score(docs).collect()}
    # others' counts: a 1, b 1, a b 1, c none; three words in all others
    by_hand = math.log(1 / 3) + math.log(1 / 1) + math.log(0.4 * 0.4 * 0.5 / 3)
    assert found[1]["log_score"] == pytest.approx(by_hand, abs=1e-5)
    assert found[3]["log_score"] is None and found[3]["n_words"] == 0


def test_rules_equal_sql(spark):
    docs = documents(spark)
    against_sql(rules.judge(docs), docs, rules.SQL)
    kept = rules.accepted(docs)
    assert kept.columns == docs.columns
    assert kept.count() == rules.judge(docs).filter("kept").count() > 0
    assert rules.judge(empty(spark)).count() == 0
    plan = rules.judge(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_guarded_rules_stand_a_dirty_source(spark):
    good = [(i, " ".join(f"word{i}x{k}" for k in range(30)), "en", "s") for i in range(120)]
    junk = [(1000 + i, " ".join(f"word{i}y{k}##" for k in range(30)), "en", "s") for i in range(80)]
    docs = spark.createDataFrame(good + junk, "doc_id bigint, text string, lang string, source string")
    kept = {i for (i,) in texts(corpus_pipeline.quality_rules(spark, docs, ""), "doc_id")}
    assert kept == set(range(120))
    # a source that is of this kind as a whole keeps its texts
    own = spark.createDataFrame([(i, t, la, "code") for i, t, la, _ in junk], docs.schema)
    assert corpus_pipeline.quality_rules(spark, own, "").count() == 80


def test_repeated_words(spark):
    rows = [("a b c d e a b c d e",), ("a b c d e f a b c d e",), ("a a a a a a",), ("a b c d",), ("x a b c d e y a b c d e",)]
    df = spark.createDataFrame(rows, "text string")
    assert [r["n_repeat_words"] for r in rules.measures(df).collect()] == [10, 10, 6, 0, 10]


def test_sketch_merges_and_bounds_its_error(spark):
    values = spark.range(1, 5000).select(F.col("id"), rules.bucket(F.col("id")).alias("b"))
    worst = values.select(F.max(F.abs(rules.bucket_value(F.col("b")) / F.col("id") - 1))).first()[0]
    assert worst <= rules.ACCURACY + 1e-9


def test_licenses_equal_sql(spark):
    extra = [
        (900, "Apache-License, mit LICENSE; General public license general PUBLIC License", "en", "a"),
        (901, "x\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and the associated files", "en", "a"),
        (902, "license mit general license public license", "en", "a"),
        (903, "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.", None, None),
    ]
    docs = documents(spark).select("doc_id", "text", "lang", "source").unionByName(spark.createDataFrame(extra, "doc_id bigint, text string, lang string, source string"))
    found = licenses.scan(docs.withColumn("label", F.lit(1)).withColumn("_mark", F.lit(2)))
    against_sql(found, docs, licenses.sql())
    rows = {r["doc_id"]: r for r in found.filter("doc_id >= 900 AND doc_id < 1000").collect()}
    assert rows[900]["n_base"] == 4 and rows[900]["base_labels"] == "apache,gpl,mit" and (rows[900]["first_word"], rows[900]["last_word"]) == (0, 7)
    assert rows[901]["labels"] == "mit-terms" and 0.8 <= rows[901]["score"] < 1
    assert rows[902]["n_base"] == 0 and rows[902]["score"] == 0
    assert rows[903]["labels"] == "cc-by-nc-4.0,gpl,gpl-3.0"
    assert licenses.scan(empty(spark)).count() == 0


def test_licenses_wrapped_over_lines(spark):
    mit = """Copyright (c) 2020 Someone\n\nPermission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal\nin the Software without restriction"""
    bsd = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions
# are met:"""
    isc = """ * Permission to use, copy, modify, and/or distribute this software for any\r
 * purpose with or without fee is hereby granted, provided that"""
    gpl = """dnl you can redistribute it and/or modify\ndnl it under the terms of the GNU General Public License as published by
dnl the Free Software Foundation"""
    apache = """you may not use this file except in compliance with the License.\n    You may obtain a copy of the License at\n"""
    prose = """this story is about the public park and a free concert that was released into the city domain by a software firm"""
    filler = " ".join(f"w{i}" for i in range(997))
    words = licenses.TEMPLATES["bsd"].split(" ")
    apart = "\n".join(f"{w} {' '.join(f'x{i}' for i in range(9))}" for w in words)
    rows = [(1, mit), (2, bsd), (3, isc), (4, gpl), (5, apache), (7, apart), (8, "\n".join(words)), (9, "\n".join(words[:14])), (10, "\n\n"), (11, prose)]
    # line ends decide nothing
    rows += [(50 + i, t.replace("\r", " ").replace("\n", " ")) for i, t in rows if i < 50]
    rows += [(100 + k, f"{filler[: k * 9]}\n{filler}\n{bsd}\n{filler}") for k in range(0, 60, 7)]  # wherever a span begins
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in licenses.scan(docs).collect()}
    assert len(found) == len(rows)
    want = {1: "mit-terms", 2: "bsd", 3: "isc", 4: "gpl,gpl-terms", 5: "apache-2.0-terms", 7: "", 8: "bsd", 9: "", 10: "", 11: ""}
    got = {i: r["labels"] for i, r in found.items() if i < 100}
    assert got == want | {50 + i: labels for i, labels in want.items()}
    plain = docs.selectExpr("doc_id", "text", "'en' AS lang", "'a' AS source")
    against_sql(licenses.scan(plain), plain, licenses.sql())
    assert found[1]["score"] == 1 and found[2]["score"] == 1 and found[7]["score"] == 0
    assert all(r["labels"] == "bsd" for i, r in found.items() if i >= 100)


def test_quality_learns_from_positives_only(spark):
    draw = np.random.default_rng(0)
    words = ["".join(draw.choice(list("abcdefghij"), draw.integers(2, 9))) for _ in range(500)]
    rows, marks = [], []
    for i in range(1500):
        text = " ".join(draw.choice(words, draw.integers(5, 60)))
        good = i % 5 != 0
        if not good:
            text = [" ".join(w + "###" for w in text.split()), text.upper() + "!!", "lo " * 40][i % 3]
        rows.append((i, text, "zz"))
        marks += [(i, int(good))] if i % 2 else []
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    assert 0.6 < model.prior <= 0.99
    found = {r["doc_id"]: r for r in quality.score(docs, model).collect()}
    test = [i for i in range(1500) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(found[i]["held_out"] for i in test) and sum(r["held_out"] for r in found.values()) == len(test)
    assert np.mean([found[i]["predicted"] == int(i % 5 != 0) for i in test]) > 0.95
    # bad labels and labels of the held-out fold change nothing
    poisoned = labels.filter("quality = 1").unionByName(labels.filter(quality.held_out("doc_id")).selectExpr("doc_id", "1 - quality AS quality"))
    assert np.allclose(quality.train(docs, poisoned).weights, quality.train(docs, labels.filter("quality = 1")).weights)
    odd = documents(spark)
    scores = texts(quality.score(odd, model), "score", "predicted", "held_out")
    assert len(scores) == odd.count() and all(0 <= s <= 1 and p == int(s >= 0.5) and h is not None for s, p, h in scores)
    assert quality.score(empty(spark), model).count() == 0
    nothing = quality.train(empty(spark), spark.createDataFrame([], "doc_id bigint, quality int"))
    assert set(texts(quality.score(odd, nothing), "score")) == {(0.5,)}
