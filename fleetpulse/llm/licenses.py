"""License scans: an exact set-similarity join with license templates, in DataFrame functions only.

Two things are found. Base phrases are counted word by word. Beyond them, every block of a text whose
words contain at least ``threshold`` of a template's words gets the template's label. A block is a window of
words, a quarter and a word longer than the template, wherever lines end: notices wrapped over lines are found,
and words of a template scattered over a long line are none:

* the templates' words are ordered by how many documents hold them, over the whole table, rarest first;
* a block that reaches the threshold shares one of the first words (the prefix) of the template, so only
  blocks with a prefix word are looked at, and joined with the templates by it;
* a pair needs enough words of the vocabulary in the block (length), and enough words after the first
  common one on both sides (position); what remains is verified.

Windows are cut from spans of twice the widest window that overlap by half, so each lies in one span and a
text is held twice at most; a span passes the same filters before its windows are looked at. The SQL starts a
window at every word of a template.

Templates are parameters, so their tables are small whatever the size of the corpus. Texts are read
twice, once to count words and once to match, and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored
from fleetpulse.llm.rules import let

# Words, base phrases and their labels.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Sentences by which licenses are declared, in words as above.
TEMPLATES = {
    "agpl": "gnu affero general public license",
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-terms": "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-4.0": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "cc-by-sa-4.0": "licensed under cc by sa 4 0",
    "cc0-1.0": "to the extent possible under law the author has waived all copyright and related rights to this work",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit-notice": "released under the mit license",
    "mit-terms": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}


def _words(text: Column) -> Column:
    return F.filter(F.split(text, GAPS), lambda w: w != "")


def _places(text: Column) -> Column:
    """(at, label) of every place of a base phrase, in words from 0."""

    def found(words: Column) -> Column:
        def at(word: Column, i: Column) -> Column:
            hit = None
            for phrase, label in PHRASES.items():
                parts = phrase.split(" ")
                back = len(parts) - 1
                same = word == parts[-1]
                for k, part in enumerate(parts[:-1]):
                    place = i - (back - k)
                    same = same & F.when(place >= 0, F.get(words, place) == part).otherwise(False)
                value = F.struct((i - back).cast("bigint").alias("at"), F.lit(label).alias("label"))
                hit = F.when(same, value) if hit is None else hit.when(same, value)
            return hit

        return F.filter(F.transform(words, at), lambda x: x.isNotNull())

    return let(_words(text), found)


def template_index(docs: DataFrame, text_col: str, templates: dict[str, str], threshold: float) -> DataFrame:
    """(label, words, size, need, prefix): templates with their words in global order, rarest first."""
    spark = docs.sparkSession
    rows = [(label, w) for label, sentence in sorted(templates.items()) for w in sorted(set(sentence.split(" ")))]
    pairs = spark.createDataFrame(rows, "label string, word string")
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for _, w in rows})])
    text = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    held = docs.select(F.explode(F.array_intersect(F.split(text, GAPS), vocabulary)).alias("held"))
    counts = held.groupBy("held").agg(F.count("*").alias("n"))
    ranked = pairs.join(counts, F.col("word") == F.col("held"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("n", "word"))), lambda x: x["word"])
    index = ranked.groupBy("label").agg(ordered.alias("words"))
    size = F.size("words")
    need = F.ceil(size * F.lit(threshold) - F.lit(1e-9)).cast("int")
    return index.select("label", "words", size.alias("size"), need.alias("need"), F.slice("words", F.lit(1), size - need + 1).alias("prefix"))


def window_width(sentence: str) -> int:
    """Words of a window for a template: a quarter and one more than it has, for comment marks between its lines."""
    n = len(sentence.split(" "))
    return n + n // 4 + 1


def _spans(text: Column, width: int, wanted: Column) -> Column:
    """Spans of 2 * ``width`` words at every ``width``-th word that hold a wanted word, joined by spaces."""

    def cut(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - width, F.lit(1)), F.lit(width))
        held = F.filter(F.transform(starts, lambda s: F.slice(words, s, F.lit(2 * width))), lambda span: F.arrays_overlap(span, wanted))
        return F.transform(held, lambda span: F.array_join(span, " "))

    return let(_words(text), cut)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None, threshold: float = 0.9
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    ``score`` is the largest share of a template's words in one block, 0 if none reaches the threshold and 1
    for a base phrase. Null and empty texts have no words and empty labels. Rows are scanned each,
    repeated ones too; rows of one id are told apart by their texts. An empty table gives no row; further
    columns are ignored.
    """
    spark = docs.sparkSession
    templates = templates or TEMPLATES
    index = stored(template_index(docs, text_col, templates, threshold), "templates")
    # bounded by the templates, which are parameters
    chosen = index.select("label", "words", "size", "need", "prefix").collect()
    prefixes = sorted({w for r in chosen for w in r["prefix"]})
    widths = {label: window_width(sentence) for label, sentence in templates.items()}
    order = spark.createDataFrame([(r["label"], w, k, r["size"], r["need"], widths[r["label"]], r["words"]) for r in chosen for k, w in enumerate(r["prefix"])],
                                  "label string, word string, at int, size int, need int, width int, words array<string>")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lowered = F.lower(text)
    wanted = F.array(*[F.lit(w) for w in prefixes])
    hopeful = F.arrays_overlap(F.split(lowered, GAPS), wanted)
    spans = F.when(hopeful, _spans(lowered, max(widths.values()), wanted)).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<struct<at: bigint, label: string>>")
    base = F.when(F.contains(lowered, F.lit("license")), _places(lowered)).otherwise(none)
    own = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(text).alias("_mark"),
            F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_words"),
            base.alias("_base"),
            spans.alias("_spans"),
        ),
        "licenses",
    )
    blocks = own.select("doc_id", "_mark", F.posexplode("_spans").alias("_k", "_span")).distinct()
    listed = blocks.select("doc_id", "_mark", "_k", _words(F.col("_span")).alias("_in"))
    sets = listed.withColumn("_set", F.array_distinct("_in"))
    pieces = sets.select("*", F.explode("_set").alias("_word"))
    met = pieces.join(F.broadcast(order), F.col("_word") == F.col("word"))
    # the first common word in the template's order decides the pair; position: the rest must suffice
    possible = met.filter((F.size("_set") >= F.col("need")) & (F.col("size") - F.col("at") >= F.col("need")))
    kept = ("_in", "_set", "words", "size", "need", "width")
    pairs = possible.groupBy("doc_id", "_mark", "_k", "label").agg(*[F.first(c).alias(c) for c in kept], F.min("at").alias("at"))
    rest = F.slice("words", F.col("at") + 1, F.col("size"))
    enough = pairs.select("*", rest.alias("_rest")).filter(F.size(F.array_intersect("_set", rest)) >= F.col("need"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("_in") - F.col("width") + 1, F.lit(1)))
    window = F.array_max(F.transform(starts, lambda s: F.size(F.array_intersect(F.slice("_in", s, F.col("width")), F.col("_rest")))))
    verified = enough.select("doc_id", "_mark", "label", "size", "need", window.alias("common")).filter("common >= need")
    labelled = verified.groupBy(F.col("doc_id").alias("_doc"), F.col("_mark").alias("_m")).agg(
        F.collect_set("label").alias("_labels"), F.max(F.col("common") / F.col("size")).alias("_score")
    )
    joined = own.join(labelled, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_mark") == F.col("_m")), "left")
    base_labels = F.array_sort(F.array_distinct(F.transform("_base", lambda x: x["label"])))
    all_labels = F.array_sort(F.array_union(base_labels, F.coalesce("_labels", F.array().cast("array<string>"))))
    starts = F.transform("_base", lambda x: x["at"])
    return joined.select(
        "doc_id",
        "n_words",
        F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(all_labels, ",").alias("labels"),
        F.when(F.size("_base") > 0, 1.0).otherwise(F.coalesce("_score", F.lit(0.0))).alias("score"),
    )


def sql(threshold: float = 0.9) -> str:
    values = ", ".join(f"('{label}', list_distinct(string_split('{sentence}', ' ')), {window_width(sentence)})" for label, sentence in TEMPLATES.items())
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lower(coalesce(text, '')) AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{word}') AS ws FROM d),
h AS (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE contains(t, 'license')),
p AS (SELECT rid, CASE WHEN ws[i - 1] = 'mit' AND i > 1 THEN i - 2 WHEN ws[i - 1] = 'apache' AND i > 1 THEN i - 2
    WHEN ws[i - 1] = 'public' AND i > 2 AND ws[i - 2] = 'general' THEN i - 3 END AS a,
  CASE WHEN ws[i - 1] = 'mit' AND i > 1 THEN 'mit' WHEN ws[i - 1] = 'apache' AND i > 1 THEN 'apache'
    WHEN ws[i - 1] = 'public' AND i > 2 AND ws[i - 2] = 'general' THEN 'gpl' END AS label FROM h WHERE ws[i] = 'license'),
b AS (SELECT rid, count(*) AS n, min(a) AS first_word, max(a) AS last_word, list(DISTINCT label) AS labels FROM p WHERE a IS NOT NULL GROUP BY rid),
s AS (SELECT label, unnest(tw) AS x, len(tw) AS size, width FROM (VALUES {values}) x(label, tw, width)),
u AS (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
k AS (SELECT rid, label, size, count(DISTINCT x) OVER (PARTITION BY rid, label ORDER BY i RANGE BETWEEN CURRENT ROW AND width - 1 FOLLOWING) AS common
  FROM u JOIN s USING (x)),
m AS (SELECT rid, label, common, size FROM k WHERE common >= ceil(size * {threshold}::DOUBLE - 1e-9)),
o AS (SELECT rid, list(DISTINCT label) AS labels, max(common::DOUBLE / size) AS score FROM m GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(o.labels, [])))), ','), '') AS labels,
  CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(o.score, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN b USING (rid) LEFT JOIN o USING (rid)
"""
