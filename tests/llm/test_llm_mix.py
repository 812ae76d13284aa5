"""Mixing, packing and pages."""

import json
import random
import time
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from llm_fixtures import documents, empty, texts
from pyspark.sql import functions as F

from fleetpulse.llm import extraction, jaccard, mixing, packing, pagetext
from fleetpulse.llm.common import BATCH_BYTES

public_tokenizers = pytest.importorskip("public_tokenizers")


def filled(sources, share=1.5, weights=(3, 1, 2), cap=2.0):
    """Targets by pouring until no source is above its cap."""
    order = sorted((s for s in sources if s is not None)) + [s for s in sources if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped = share * sum(sources.values()), {}
    while True:
        left = total - sum(capped.values())
        rest = [s for s in order if s not in capped]
        level = left / sum(weight[s] for s in rest)
        over = [s for s in rest if level * weight[s] > cap * sources[s]]
        if not over:
            return capped | {s: level * weight[s] for s in rest}
        capped |= {s: cap * sources[s] for s in over}


@pytest.mark.parametrize("block_rows", [2000, 7])
def test_mix_is_balanced_and_repeatable(spark, block_rows):
    docs = documents(spark, n=300)
    rows = texts(mixing.mix(docs, block_rows=block_rows), "doc_id", "source", "size", "source_size", "target", "copies")
    assert len(rows) == docs.count()
    again = texts(mixing.mix(docs.repartition(3), block_rows=block_rows), "doc_id", "source", "size", "source_size", "target", "copies")
    key = lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in r)
    assert sorted(rows, key=lambda r: repr(key(r))) == sorted(again, key=lambda r: repr(key(r)))
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, source, size, source_size, target, copies in rows:
        sizes[source] += size
        taken[source] += copies * size
        largest[source] = max(largest[source], size)
        assert 0 <= copies <= 2
    want = filled(sizes)
    for _, source, _, source_size, target, _ in rows:
        assert source_size == sizes[source] and target == pytest.approx(want[source])
    for source in sizes:
        assert abs(taken[source] - want[source]) <= max(5, 0.02 * want[source], 0.5 * largest[source] if largest[source] > 20000 else 0)


def test_flight_keeps_totals():
    import random

    sizes = [float(x) for x in (5, 5, 9, 12, 30, 31, 31, 80, 200, 3)]
    chances = mixing.fly(sizes, [0.3] * 10, random.Random(1))
    assert sum(c * s for c, s in zip(chances, sizes)) == pytest.approx(0.3 * sum(sizes))
    assert sum(chances) == pytest.approx(3.0)
    assert sum(0 < c < 1 for c in chances) <= 2
    assert all(c in (0.0, 1.0) for c in mixing.land(sizes, chances))


def test_mixed_repeats_documents(spark):
    docs = documents(spark)
    drawn = mixing.mix(docs)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == drawn.agg({"copies": "sum"}).first()[0]
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = ["don't 'S we'LL", "a<|endoftext|>b <|startoftext|>", "İ ﬁ K Å é", "x y z", "ẞ ŸÜ, Ǆ 日本語 12.5%", "\x1c\x85a"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(odd)], "doc_id bigint, text string, length int")
    docs = docs.unionByName(documents(spark).select("doc_id", "text").selectExpr("doc_id + 10 AS doc_id", "text", "1 AS length"))
    pieces = packing.pack(docs, path, longest=64).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = defaultdict(list)
    for p in pieces:
        assert p["length"] == 1 << p["bucket"] <= 64 and len(p["ids"]) == 4 * p["length"] and p["offset"] == 0
        found[p["doc_id"]].append(p)
    assert len({p["sequence_id"] for p in pieces}) == len(pieces) and all(p["sequence_id"] % 64 == p["bucket"] for p in pieces)
    want = defaultdict(list)
    for key, text in rows:
        want[key].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2])
    for key, encoded in want.items():
        own = sorted(found[key], key=lambda p: p["start"])
        total = b"".join(p["ids"] for p in own)
        assert len(total) == 4 * sum(map(len, encoded))
        if len(encoded) == 1:
            assert total == b"".join(i.to_bytes(4, "little") for i in encoded[0])
            assert [p["start"] for p in own] == [sum(q["length"] for q in own[:k]) for k in range(len(own))]
            assert {p["doc_tokens"] for p in own} == {len(encoded[0])}
    assert zlib.crc32(b"") == 0 and packing.pack(empty(spark), path).count() == 0


def _texts(tmp_path, change):
    """A coder that counts the texts its tokenizer gets, and the tokenizer itself."""
    from tokenizers import Tokenizer

    spec = json.loads(open(public_tokenizers.path("word_bpe_49k.json")).read())
    change(spec)
    path = tmp_path / "tokenizer.json"
    path.write_text(json.dumps(spec))
    coder, plain, given = packing.WordIds(str(path)), Tokenizer.from_file(str(path)), []

    class Counted:
        def encode_batch_fast(self, texts, **kwargs):
            given.extend(texts)
            return plain.encode_batch_fast(texts, **kwargs)

    coder._tokenizer = Counted()
    return coder, plain, given


def _same(coder, plain, texts):
    ids, sizes = coder.encode(pa.array(texts))
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


LATIN = [chr(c) for c in range(0x21, 0x100) if c > 0xA0 or c < 0x7F]
MARKS = '.,:;!?#*$%&|()"-'


def test_letters_and_marks_go_to_the_model(tmp_path, monkeypatch):
    coder, plain, given = _texts(tmp_path, lambda spec: None)
    chance = random.Random(6)
    letters = [c for c in LATIN if c.isalpha() and c not in "ªºµ"]
    words = ["".join(chance.choices(letters, k=chance.randint(1, 12))) for _ in range(3000)]
    marked = [w + "".join(chance.choices(MARKS, k=chance.randint(0, 4))) for w in words]
    _same(coder, plain, [" ".join(words[:1500]), "", " ".join(marked), " \n"])
    assert given == []  # was a text for every distinct word
    odd = ["".join(chance.choices(LATIN, k=chance.randint(1, 6))) for _ in range(3000)]
    _same(coder, plain, ["\n".join(odd), "\t".join(marked), "don't , ,, 'S a's 12.5% <|endoftext|> e\u0301 日本語"])
    assert given and not set(given) & {w.lower() for w in words}
    monkeypatch.setattr(packing, "KEPT_WORDS", 100)
    for k in range(0, 3000, 500):
        _same(coder, plain, [" ".join(marked[k : k + 500]), " ".join(odd[k : k + 500])])
        assert len(coder._known) < 3000
    monkeypatch.setattr(packing, "KEPT_BYTES", 0)
    _same(coder, plain, ["", ""])
    assert len(coder._known) == 1


def test_tokenizers_that_cut_words_get_them_as_texts(tmp_path):
    def cut(spec):
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]
        pattern["Regex"] = pattern["Regex"].replace("[\\p{L}]+", "[\\p{L}]{1,3}")

    def added(spec):
        spec["added_tokens"].append(dict(spec["added_tokens"][0], id=49408, content="the"))

    for change in (cut, added):
        coder, plain, given = _texts(tmp_path, change)
        _same(coder, plain, ["other words, in the éèê text!", "", "other -- anthem"])
        assert "other" in given and "éèê" in given


@pytest.mark.parametrize("build", [lambda docs: packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")), jaccard.joined])
def test_workers_are_given_few_bytes_at_once(spark, build):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(0, 400, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 5000).alias("text"))
    measure = lambda batches: (pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]}) for batch in batches)
    try:
        spark.conf.unset(key)
        build(docs)
        sizes = [row[0] for row in docs.mapInArrow(measure, "bytes bigint").collect()]
        assert sum(sizes) > 20_000_000 and max(sizes) < 2 * BATCH_BYTES
    finally:
        spark.conf.set(key, before)


def test_packing_gives_back_after_every_chunk(spark, monkeypatch):
    seen, cuts = [], []
    monkeypatch.setattr(packing, "give_back", lambda: seen.append("given back"))
    monkeypatch.setattr(packing, "CHUNK_BYTES", 40)
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda self, cut, schema: cuts.append(cut) or spark.createDataFrame([], schema))
    packing.pack(spark.createDataFrame([(0, "")], "doc_id bigint, text string"), public_tokenizers.path("word_bpe_49k.json"))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, None, 4], "text": ["so many words " * 3, None, "", "a few more of them " * 3]})
    assert sum(seen.append("rows") or rows.num_rows for rows in cuts[0]([batch])) >= 4
    assert seen.count("rows") > 1 and seen[1::2] == ["given back"] * (len(seen) // 2)


def test_power_lengths():
    assert packing.power_lengths(1, 8) == [1] and packing.power_lengths(8, 8) == [8] and packing.power_lengths(31, 8) == [8, 8, 8, 4, 2, 1]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="page-%d">
<nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- <p>no</p> --><div class="cookie-notice">We use cookies and more cookies than you want to read about</div>
<div class="col-%d"><div class="post-body"><h1>Title &amp; more</h1><p>First   <b>bold
text</b> here&nbsp;now.<p>Second &lt;tag&gt; <a href=x>link</a><br>after</div></div>
<aside>Side bar text of some length</aside><form>Your name <input name="a>b"></form>
<section id="comments"><article class="comment"><p>A reader's comment that is long enough to be mistaken for the article itself, if nothing helps</p></article></section>
<footer>&copy; footer</footer></body></html>"""


def test_pages_keep_the_whole_article(spark):
    parts = '<h1>Title</h1><p>Lead of the text.</p><div class="body"><p>%s</p></div>' % ("long text " * 40)
    whole = "Title\n\nLead of the text.\n\n" + ("long text " * 40).strip()
    nav = '<nav>menu</nav><div class="ad">buy</div>'
    rows = [
        (1, "http://a.example/1", f"<html><body>{nav}<article>{parts}</article></body></html>"),
        (2, "http://b.example/1", f'<html><body>{nav}<div class="post">{parts}</div><div><a href="/">home page</a></div></body></html>'),
        (3, "http://c.example/1", f'<html><body><div class="name">The site</div><main><article>{parts}</article></main></body></html>'),
        (4, "http://d.example/1", f"<html><body><main><h1>Title</h1><article>{parts[14:]}</article></main></body></html>"),
        *[(k, "http://e.example/1", f'<html><body><div class="post">{parts}</div></body></html>') for k in (5, 6)],
        (7, "http://e.example/2", f'<html><body><div class="post"><img src="a.png"></div><div class="story">{parts}</div></body></html>'),
    ]
    found = dict(texts(extraction.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")), "page_id", "text"))
    assert found == {k: whole for k in range(1, 8)}


def test_pages_named_like_something_else(spark):
    parts = "<p>%s</p>" % ("long text " * 40)
    title, whole = "<h1>Title</h1>", "Title\n\n" + ("long text " * 40).strip()
    comments = '<div class="comments"><h1>Readers</h1><p>%s</p></div>' % ("my view " * 200)
    bodies = [
        f'<div class="news-alert">{title}{parts}</div><div class="site-footer">imprint</div>',
        f'<article class="post social">{title}{parts}<div class="share">Share this</div></article>{comments}',
        f"<article><header><nav>menu</nav>{title}<p>By somebody</p></header>{parts}</article>",
        f'<header>{title.replace("Title", "Site")}</header><main><article><header>{title}</header>{parts}</article></main>',
        f'<div class="post">{title}{parts}</div><div class="promo"><p>{"buy now " * 200}</p></div>',
        f'<div id="banner"><div class="alert">{title}{parts}<form>name</form></div></div>',
    ]
    rows = [(i, f"http://{i}.example/", f"<html><body>{body}</body></html>") for i, body in enumerate(bodies)]
    found = dict(texts(extraction.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")), "page_id", "text"))
    assert found == dict.fromkeys(range(len(bodies)), whole)


def test_deeply_nested_page():
    begin = time.monotonic()
    page = pagetext.Page("<p>start</p>" + '<div class="w-1/2">' * 20000 + "deep" + "</div>" * 20000 + "<b>end")
    path, held = page.best()
    assert (path, held) == ("", 12) and page.text(path) == "start\n\ndeep\n\nend"
    assert page.text("/div.w-#/#") == page.text("/div.w-#/#" * 20000) == "deep" and page.text("/div") is None
    assert time.monotonic() - begin < 5


def test_votes_equal_a_count_by_hand(spark):
    kinds = ["<article>%s</article>", '<div class="post-%d">%%s</div>', "%s", "<main><p>x<article>%s</article></main>"]
    rows = []
    for i in range(60):
        kind = kinds[i * i % 7 % 4]
        rows.append((i, f"http://h{i % 5}.example/{i}", "<body>" + (kind % i if "%d" in kind else kind) % ("text " * (i % 6)) + "</body>"))
    votes = defaultdict(lambda: [0, 0])
    for i, _, source in rows:
        path, held = pagetext.Page(source).best()
        if held:
            votes[f"h{i % 5}.example", path][0] += 1
            votes[f"h{i % 5}.example", path][1] += held
    want = {h: min((-n, -c, p) for (host, p), (n, c) in votes.items() if host == h)[2] for h in {h for h, _ in votes}}
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", extraction.host_of(F.col("url")))
    assert dict(texts(extraction.winning_paths(pages), "_host", "path")) == want


def test_pages_follow_their_host(spark):
    short = '<html><body class="page-3"><div class="col-9"><div class="post-body"><p>Hi.</p></div></div><div class="x">Unmarked text that is longer than the article is</div></body></html>'
    rows = [(i, "http://user@H.example:80/p?x", PAGE % (i, i)) for i in range(5)]
    rows += [(5, "https://h.EXAMPLE/q", short), (6, None, None), (7, "", ""), (8, "http://other.example", "<p>Just <i>this</i>"), (8, "http://other.example", "<p>Just <i>this</i>"), (None, "bad url", "a < b & c")]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id bigint, url string, html string, text string, n_chars int")
    found = sorted(texts(extraction.extract(pages), "page_id", "text", "n_chars"), key=lambda r: (r[0] is None, r[0] or 0))
    article = "Title & more\n\nFirst bold text here now.\n\nSecond <tag> link after"
    assert [t for _, t, _ in found] == [article] * 5 + ["Hi.", "", "", "Just this", "Just this", "a < b & c"]
    assert all(n == len(t) for _, t, n in found)
    assert extraction.extract(pages.limit(0)).count() == 0
