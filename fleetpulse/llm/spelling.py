"""Spelling variants: words one edit apart, found by a frontier that walks a relational trie.

The trie is an edge table: (node, label, child, word that ends at the child), a node being the hash of the
prefix that leads to it. States (word, position, node, edits) meet the edges of their level in one join
each: a state with an edit follows the edge of its next code point; a state without one has reached the
node of its own prefix and makes its edit at the first edge that differs, which replaces a code
point or inserts one. A state whose word is used up at a node where a word ends gives a pair.

Walking from the root would meet nearly all edges of the first levels. Of two words one edit apart either the first
halves agree or the last ones, so every word is in the trie twice, as it is and reversed, and makes no edit
before its half. Words beyond ``LONG`` code points would need as many levels: they are paired by the
hashes of what is left when one code point is deleted, and compared exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored
from fleetpulse.llm.packed import mix

# Fixed value: what a word is made of.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Longest word that walks the trie.
LONG = 32


def word_counts(docs: DataFrame, id_col: str, text_col: str, drop_every: int, least_length: int, least_count: int) -> DataFrame:
    """(word, n): runs of letters after the planned misspelling, long and frequent enough."""
    lowered = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    number = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"))
    runs = docs.select(number.alias("_id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("_run"))
    hashed = F.crc32(F.concat("_id", "_run"))
    place = (F.col("_h") % F.char_length("_run")).cast("int")
    rest = F.concat(F.substring(F.col("_run"), F.lit(1), place), F.substring(F.col("_run"), place + 2, F.char_length("_run")))
    # only words that can be long enough are hashed
    some = runs.filter(F.char_length("_run") >= least_length).select("_run", hashed.alias("_h"))
    words = some.select(F.when(F.col("_h") % drop_every == 0, rest).otherwise(F.col("_run")).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter((F.char_length("word") >= least_length) & (F.col("n") >= least_count))


def _node(text: Column, way: Column, upto) -> Column:
    return F.xxhash64(way, F.substring(text, F.lit(1), upto))


def both_ways(words: DataFrame) -> DataFrame:
    """(text, way, size, half): every word as it is and reversed, and the level from which it may be edited."""
    way = F.explode(F.array(F.lit(0), F.lit(1))).alias("way")
    rows = words.select("word", F.char_length("word").alias("size"), way)
    text = F.when(F.col("way") == 0, F.col("word")).otherwise(F.reverse("word"))
    return rows.select(text.alias("text"), "way", "size", F.floor((F.col("size") + 1 - F.col("way")) / 2).cast("int").alias("half"))


def edge_table(texts: DataFrame, least_level: int) -> DataFrame:
    """(level, node, label, child, ends): the trie's edges from ``least_level`` on; ``ends`` is the text that ends there."""
    level = F.explode(F.sequence(F.lit(least_level), F.col("size") - 1)).alias("level")
    steps = texts.filter(F.col("size") > least_level).select("text", "way", "size", level)
    at = F.col("level")
    found = steps.select(
        "level",
        _node(F.col("text"), F.col("way"), at).alias("node"),
        F.substring(F.col("text"), at + 1, F.lit(1)).alias("label"),
        _node(F.col("text"), F.col("way"), at + 1).alias("child"),
        F.when(at + 1 == F.col("size"), F.col("text")).alias("ends"),
    )
    return found.groupBy("level", "node", "label", "child").agg(F.max("ends").alias("ends"))


def advance(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one level deeper: all of them have made their edit."""
    here, at = F.substring(F.col("text"), F.col("at") + 1, F.lit(1)), F.col("at")
    used = at == F.col("size")
    edge = edges.select(F.col("node").alias("_node"), "label", "child", "ends")
    met = states.join(edge, (F.col("node") == F.col("_node")) & ((F.col("edits") == 0) | (F.col("label") == here)))
    follows = F.when(F.col("edits") == 1, at + 1)
    # of two words of one length the smaller replaces; of two lengths the shorter inserts
    replaces = F.when((F.col("edits") == 0) & ~used & (F.col("label") > here), at + 1)
    inserts = F.when((F.col("edits") == 0) & (used | (F.col("label") != here)), at)
    place = F.explode(F.array_compact(F.array(follows, replaces, inserts))).alias("at")
    return met.select("text", "way", "size", place, F.col("child").alias("node"), F.lit(1).alias("edits"), "ends")


def _walked(words: DataFrame) -> DataFrame:
    """(a, b): pairs of words, of at most ``LONG`` code points each, that are one edit apart."""
    texts = stored(both_ways(words.filter(F.char_length("word") <= LONG)), "words")
    low, high = texts.agg(F.min("half"), F.max("size")).first()
    pairs = words.select(F.col("word").alias("a"), F.col("word").alias("b")).limit(0)
    if low is None:
        return pairs
    edges = stored(edge_table(texts, low), "edges", by="level")
    states = None
    for level in range(low, high + 1):
        own = _node(F.col("text"), F.col("way"), F.lit(level)).alias("node")
        fresh = texts.filter(F.lit(level).between(F.col("half"), F.col("size"))).select("text", "way", "size", F.lit(level).alias("at"), own, F.lit(0).alias("edits"))
        at_level = edges.filter(F.col("level") == level).drop("level")
        states = stored(advance(fresh if states is None else states.unionByName(fresh), at_level), "states")
        word = lambda c: F.when(F.col("way") == 0, F.col(c)).otherwise(F.reverse(c))
        done = states.filter("at = size AND ends IS NOT NULL").select(word("text").alias("a"), word("ends").alias("b"))
        pairs = done if level == low else pairs.unionByName(done)
        states = states.filter("at < size").drop("ends")
    return pairs.distinct()


def _deletions(batches):
    """(id, size, place, hash) of long words: the whole (place -1), and what is left without each code point.

    Hashes are polynomials, so that all deletions of a word take time in proportion to it; equal hashes
    are only candidates.
    """
    base = 0x9E3779B97F4A7C15
    inverse = np.uint64(pow(base, -1, 1 << 64))
    for batch in batches:
        for key, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes = mix(np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64))
            powers = np.cumprod(np.full(len(codes), base, np.uint64), dtype=np.uint64)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers, dtype=np.uint64)])
            left = sums[:-1] + (sums[-1] - sums[1:]) * inverse
            hashes, places = np.concatenate([sums[-1:], left]).view(np.int64), np.arange(-1, len(codes))
            same = np.full((2, len(places)), [[key], [len(codes)]])
            yield pa.RecordBatch.from_arrays([pa.array(same[0]), pa.array(same[1]), pa.array(places), pa.array(hashes)], ["id", "size", "place", "hash"])


def _long_pairs(words: DataFrame) -> DataFrame:
    """(a, b): pairs one edit apart of which one word at least is longer than ``LONG``."""
    long = words.filter(F.char_length("word") >= LONG).select(F.monotonically_increasing_id().alias("id"), "word")
    long = stored(long, "long")
    left = stored(long.mapInArrow(_deletions, "id bigint, size bigint, place bigint, hash bigint"), "deletions")
    one = left.select(F.col("id").alias("_x"), "hash", F.col("size").alias("_m"), F.col("place").alias("_p"))
    two = left.select(F.col("id").alias("_y"), F.col("hash").alias("_hash"), F.col("size").alias("_n"), F.col("place").alias("_q"))
    replaced = (F.col("_m") == F.col("_n")) & (F.col("_p") == F.col("_q")) & (F.col("_p") >= 0) & (F.col("_x") < F.col("_y"))
    inserted = (F.col("_m") + 1 == F.col("_n")) & (F.col("_p") < 0) & (F.col("_q") >= 0)
    met = one.join(two, (F.col("hash") == F.col("_hash")) & (replaced | inserted)).filter(F.col("_n") > LONG).select("_x", "_y").distinct()
    named = met.join(long.select(F.col("id").alias("_x"), F.col("word").alias("a")), "_x").join(long.select(F.col("id").alias("_y"), F.col("word").alias("b")), "_y")
    return named.select("a", "b").filter(F.levenshtein("a", "b", 1) == 1)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): each two words that differ by one inserted, deleted or replaced code point, once."""
    return _walked(words).unionByName(_long_pairs(words))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms, by doubling; forms: (word, form), chains without cycles."""
    links = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = links.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = stored(links.join(onward, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        if moved.filter("_moved").isEmpty():
            return moved.select("word", "root")
        links = moved.drop("_moved")


def group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 6,
    least_count: int = 5,
    times: int = 5,
    drop_every: int = 199,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the corpus that is long and frequent enough.

    A word is a run of letters, A-Z lower-cased. Where ``drop_every`` divides the CRC-32 of
    ``<id>:<run>``, the run loses one code point first. The form is the near word that occurs most
    often (ties: the smallest), if it does at least ``times`` as often as the word. Null texts have no words, a
    null id reads as empty text; repeated rows count each; an empty table, or one without such
    words, gives no row. Further columns are ignored.
    """
    words = stored(word_counts(docs, id_col, text_col, drop_every, least_length, least_count), "vocabulary")
    pairs = stored(near_pairs(words), "pairs")
    near = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = words.select(F.col("word").alias("_w"), F.col("n").alias("_n"))
    # ties go to the smallest: of equal counts the one that sorts first
    ranked = near.join(counts, F.col("b") == F.col("_w")).groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("_n")).alias("m"), F.col("b"))).alias("_f"))
    named = words.join(ranked, F.col("word") == F.col("a"), "left")
    takes = -F.col("_f.m") >= times * F.col("n")
    named = named.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(takes, F.col("_f.b")).alias("form"), F.when(takes, -F.col("_f.m")).alias("form_n")
    )
    named = stored(named, "forms")
    ends = roots(named.filter("form IS NOT NULL")).select(F.col("word").alias("_w"), "root")
    joined = named.join(ends, F.col("word") == F.col("_w"), "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = r"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda b: list_reduce([b] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
o AS (SELECT doc_id, run, count(*) AS times FROM r WHERE length(run) >= 6 GROUP BY ALL),
b AS (SELECT run, times, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM o),
h AS (SELECT run, times, xor(list_reduce([4294967295] || list_transform(range(length(x) // 2), lambda i: (strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1),
  lambda c, v: xor(c // 256, crc[xor(c % 256, v) + 1])), 4294967295) AS h FROM b, t),
u AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, times FROM h),
w AS (SELECT word, sum(times)::BIGINT AS n FROM u GROUP BY word HAVING length(word) >= 6 AND sum(times) >= 5),
v AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w),
d AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM v),
p AS (SELECT a.word AS x, b.word AS y FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, w.word FROM d JOIN w ON w.word = d.rest UNION SELECT w.word, d.word FROM d JOIN w ON w.word = d.rest),
q AS (SELECT x, count(*) AS n_near, min({'m': -n, 'f': y}) AS f FROM p JOIN w ON w.word = y GROUP BY x),
k AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -f.m >= 5 * n THEN f.f END AS form, CASE WHEN -f.m >= 5 * n THEN -f.m END AS form_n FROM w LEFT JOIN q ON x = word),
g(word, root) AS (SELECT word, word FROM w UNION SELECT g.word, k.form FROM g JOIN k ON k.word = g.root WHERE k.form IS NOT NULL)
SELECT k.word, k.form, g.root, k.n, k.n_near::BIGINT AS n_near, k.form_n::BIGINT AS form_n
FROM k JOIN g USING (word) JOIN k e ON e.word = g.root AND e.form IS NULL
"""
