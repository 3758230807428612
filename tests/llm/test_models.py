"""SimHash, nearest neighbours, sharding, toxicity, HTML text and BPE against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import ann, bpe, html_extract, queries, sharding, simhash, toxicity
from strata.llm.common import components


def union_find(nodes, edges):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100 + r.randint(0, 80), 100 + r.randint(0, 80)) for _ in range(60)] + [(500, 500 + i) for i in range(40)] + [(-5, 7)]
    got = {x.node: x.label for x in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    want = union_find({n for e in edges if e[0] != e[1] for n in e}, edges)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def fingerprint_by_hand(text):
    words = (text or "").encode().lower().replace(b"\x0b", b" ").split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_brute_force(spark, sf, docs):
    rows = [(i, t) for i, t in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    r = random.Random(4)
    base = " ".join(r.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(r.randint(0, 99)) for _ in range(150))
    for i in range(150):  # a dense family of near copies
        words = base.split()
        words[r.randrange(150)] = f"w{i}"
        rows.append((10_000 + i, " ".join(words)))
    rows += [(20_000, None), (20_001, ""), (20_002, " \n\x0b"), (20_003, "one two"), (None, "One\tTWO"), (20_004, "Ärger É"), rows[0], (20_005, "x " * 70_000)]
    got = simhash.near_duplicates(docs(rows)).collect()
    fps = {t: fingerprint_by_hand(t) for t in {t for _, t in rows} if t is None or len(t) < 50_000}
    assert len(got) == len(rows)
    by_id = {x.id: x.fp % 2**64 for x in got}
    for i, t in rows:
        if t in fps:
            assert by_id[i] == fps[t], i
    all_fps = sorted({x.fp % 2**64 for x in got})
    links = [(a, b) for j, a in enumerate(all_fps) for b in all_fps[:j] if (a ^ b).bit_count() <= 4]
    label = union_find(all_fps, links)
    least = {}
    for x in got:
        if x.id is not None:
            c = label[x.fp % 2**64]
            least[c] = min(least.get(c, x.id), x.id)
    assert all(x.component_id == least.get(label[x.fp % 2**64]) for x in got)
    kept = simhash.near_duplicate_docs(docs(rows))
    assert kept.columns[2:] == ["id", "tid", "score", "words"] and kept.count() == len(set(label.values()))
    assert simhash.near_duplicates(docs([])).count() == 0 and simhash.near_duplicate_docs(docs([])).count() == 0


def test_segments_by_number_of_fingerprints():
    assert [simhash.best_segments(n, 4) for n in (1, 10**6, 10**9, 10**11)] == [3, 3, 2, 2]


@pytest.mark.parametrize("bits, small, segments", [(0, 64, 3), (1, 0, None), (3, 64, 2), (4, 64, None), (4, 0, 3), (4, 2, 2), (7, 2, 3)])
def test_hamming_links_are_complete(spark, monkeypatch, bits, small, segments):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    r = random.Random(bits)
    fps = [0, -1] + [r.getrandbits(63) for _ in range(30)]
    for f in list(fps):
        for _ in range(6):
            g = f
            for b in r.sample(range(64), r.randint(1, bits + 2)):
                g ^= 1 << b
            g %= 2**64
            fps.append(g - 2**64 if g >> 63 else g)
    got = {x.fp: x.component_id for x in simhash.link(spark.createDataFrame(list(enumerate(fps)), "id long, fp long"), bits, segments).collect()}
    keys = sorted(set(fps))
    label = union_find(keys, [(a, b) for j, a in enumerate(keys) for b in keys[:j] if ((a ^ b) % 2**64).bit_count() <= bits])
    least = {}
    for i, f in enumerate(fps):
        least.setdefault(label[f], i)
    assert got == {f: least[label[f]] for f in keys}


def exact_nearest(rows, k, every):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for q, x in ok:
        if q % every == 0:
            scored = sorted((-float((x * y).sum() / (np.sqrt((y * y).sum()) * np.sqrt((x * x).sum()))), i) for i, y in ok if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_nearest_recall_and_scores(spark, sf):
    rows = [(x.vec_id, x.embedding) for x in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0, 5, block=1500).collect()
    want = exact_nearest([(i, np.array(v, np.float32).tolist()) for i, v in rows], 5, 50)
    mine = {}
    for x in sorted(got, key=lambda x: (x.query_id, x["rank"])):
        mine.setdefault(x.query_id, []).append((x.vec_id, x.score))
    assert set(mine) == set(want)
    hits = sum(len({i for i, _ in mine[q]} & {i for i, _ in w}) for q, w in want.items())
    assert hits >= 0.99 * sum(map(len, want.values()))
    for q, w in want.items():
        scores = dict(w)
        assert all(abs(s - scores[i]) < 1e-12 for i, s in mine[q] if i in scores)


def test_nearest_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (10, [0.0, 1.0]), (10, [0.0, 1.0])]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<double>, score double")
    got = [(x.query_id, x["rank"], x.vec_id, x.score) for x in ann.search(df, F.col("vec_id") % 5 == 0, 5).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 10, 0.0), (0, 4, 10, 0.0), (10, 1, 0, 0.0), (10, 2, 1, 0.0), (10, 3, 2, 0.0)]
    assert ann.search(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_error_bound_holds():
    rng = np.random.default_rng(1)
    for dim in (64, 100):
        v = rng.standard_normal((2000, dim))
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        turn = ann.rotation(dim)
        codes, scalars = ann.encode(v, turn)
        inside = [np.mean(np.abs(g - v @ q) <= b) for q in v[:20] for g, b in [ann.estimate(codes, scalars, q, turn)]]
        assert np.mean(inside) > 0.99


def test_pack_is_best_fit_decreasing():
    r = random.Random(6)
    for _ in range(30):
        sizes = [r.randint(1, 60) for _ in range(r.randint(1, 300))]
        rest, want = [], [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            fits = [(left, b) for b, left in enumerate(rest) if left >= sizes[i]]
            b = min(fits)[1] if fits else len(rest)
            rest += [100] * (b == len(rest))
            rest[b] -= sizes[i]
            want[i] = b
        assert sharding.pack(sizes, 100) == (want, len(rest))
    assert sharding.pack([5], 4) is None and sharding.pack([], 4) == ([], 0) and sharding.pack([3, 3], 4, 1) is None


def test_shards(spark, sf, docs):
    r = random.Random(7)
    rows = [(i, "x" * r.randint(0, 400) + str(i)) for i in range(3000)] + [(5000 + i, "copy " * 30) for i in range(300)] + [(None, "n"), (None, None), (9000, ""), (9001, None), (1, "again"), (1, "again")]
    df = docs(rows)
    got = sharding.shard(df, F.octet_length(F.coalesce("text", F.lit(""))) + 16, F.coalesce("text", F.lit("")), "doc_id", shards=10, extra={"t": F.col("text")}).collect()
    assert len(got) == len(rows)
    where, load, slots = {}, [0] * 10, {}
    for x in got:
        assert x.size == len(x.t or "") + 16
        assert where.setdefault(x.t or "", x.shard) == x.shard
        load[x.shard] += x.size
        slots.setdefault(x.shard, []).append(x.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load) - min(load) <= 0.02 * max(load), load
    assert sharding.shard(docs([]), F.lit(1), F.col("text"), "doc_id").count() == 0
    # light parcels go through further levels of slices
    deep = sharding.shard(df, F.octet_length(F.coalesce("text", F.lit(""))) + 16, F.coalesce("text", F.lit("")), "doc_id", shards=4, parcels=16, extra={"t": F.col("text")}, slice_size=8).collect()
    assert len(deep) == len(rows) and len({(x.shard, x.slot) for x in deep}) == len(rows)
    where, load = {}, [0] * 4
    for x in deep:
        assert where.setdefault(x.t or "", x.shard) == x.shard
        load[x.shard] += x.size
    assert sum(load) == sum(x.size for x in got) and max(load) - min(load) <= 0.05 * max(load), load
    # a group above the fair share has a shard of its own, the others stay near equal
    load = [0] * 5
    sizes = [900] + [r.randint(1, 9) for _ in range(200)]
    for s, b in zip(sizes, sharding.pack_into(sizes, 5)):
        load[b] += s
    assert load[0] == 900 and max(load[1:]) - min(load[1:]) <= 9


def test_slots_of_repeated_rows(spark, docs, monkeypatch):
    """Equal rows spread over bounded pieces; slots stay gapless."""
    monkeypatch.setattr(sharding, "PIECE", 100)
    df = docs([(1, "same")] * 3000 + [(i, f"text {i}") for i in range(500)])
    got = sharding.shard(df, F.octet_length("text"), F.col("text"), "doc_id", shards=3).collect()
    slots = {}
    for x in got:
        slots.setdefault(x.shard, []).append(x.slot)
    assert len(got) == 3500 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_toxicity(spark, docs):
    r = random.Random(8)
    noise = [f"{a}{b}" for a in "bcdfgklm" for b in ("ara", "ono", "iti", "ule", "enn")]
    rows, labels = [], []
    for i in range(1500):
        y = int(r.random() < 0.2)
        words = [r.choice(noise) for _ in range(r.randint(5, 60))]
        if y:
            words[r.randrange(len(words))] = "Vile,"
        rows.append((i, " ".join(words)))
        labels.append((i, y, "z"))
    odd = [(9000, None), (9001, ""), (None, "vile"), (9002, "vile " * 30_000)]
    df = docs(rows + odd + [rows[0]])
    known = spark.createDataFrame(labels + [(None, 1, "z"), (9001, None, "z"), (77_777, 1, "z")], "doc_id long, toxic int, text string")
    scored = df.select("doc_id", toxicity.scorer(df, toxicity.fit(df, known))(F.col("text")).alias("s"), toxicity.held_out(F.col("doc_id")).alias("h")).collect()
    assert len(scored) == len(rows) + 5 and all(0 <= x.s <= 1 for x in scored)
    truth = {i: y for i, y, _ in labels}
    held = [x for x in scored if x.h and x.doc_id in truth]
    assert {x.doc_id for x in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([(x.s >= 0.5) == truth[x.doc_id] for x in held]) > 0.97
    one = known.filter("toxic = 1")
    assert toxicity.score(df, toxicity.fit(df, one)).filter("score < 0.99").count() == 0
    assert toxicity.score(df, toxicity.fit(df, known.limit(0))).filter("score > 0.01").count() == 0
    assert toxicity.score(df.limit(0), toxicity.fit(df.limit(0), known)).count() == 0


def test_toxicity_repeated_rows_in_the_sample(spark, docs, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "cut", lambda df, name, real=toxicity.cut: (seen.append((name, out := real(df, name))), out)[1])
    rows = [(i, f"good words {i}" if i % 2 else f"bad words {i}") for i in range(40)]
    rows += [(1, "good words 1")] * 300 + [(2, f"bad text {i}") for i in range(300)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, toxic int")
    for bound, most in ((1000, 340), (50, 100)):
        toxicity.fit(docs(rows), labels, train_rows=bound)
        sample = next(df for name, df in reversed(seen) if name == "toxicity-train")
        assert 0 < sample.count() <= most and sample.filter("id = 1").count() <= 1


def test_toxicity_bounded_sample(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    at, w, bias = toxicity.fit(docs, labels, train_rows=100)
    assert len(at) == len(w) and -35 <= bias <= 35


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><nav><ul><li>Menu</ul></nav><div id=top>Our site</div>
<article class=post><h1>Head &amp;lt; &eacute;</h1><p>One <b>two<br>three<p>four<!-- no --> five<div class="comments"><p>bad</div><aside>ad</aside><ul><li>x<li>y</ul>tail</article>
<div class="ad">buy</div><div>Imprint {n}</div><footer>&copy; f</footer>"""


def test_html(spark):
    assert html_extract.main_text(PAGE) == "Head &lt; é\n\nOne two three\n\nfour five\n\nx\n\ny\n\ntail"
    plain = "<body><div>Own site</div><div><p>Text {n} of&nbsp;page</p></div><div class='ad'>x</div></body>"
    rows = [(i, f"http://h.example/{i}", plain.replace("{n}", str(i)), "t") for i in range(10)]
    rows += [(20, None, plain, "t"), (21, "no url", "plain <text", "t"), (22, "http://i.example", None, "t"), (23, "http://i.example", "", "t"), (24, "http://h.example", "<div>Own site</div>", "t"), (None, "http://i.example", "<p>a" * 3000, "t"), rows[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    for limit in (html_extract.MAX_BROADCAST, 0):
        got = html_extract.extract_main_text(df, max_broadcast=limit).select(F.col("page.page_id").alias("i"), F.col("page.text").alias("mine"), "text").collect()
        text = {x.i: x.text for x in got}
        assert len(got) == len(rows) and got[0].mine == "t"
        assert text[3] == "Text 3 of page"  # the recurring first block is the site's template
        assert text[20] == "Own site\n\nText {n} of page"
        assert (text[21], text[22], text[23], text[24]) == ("plain <text", "", "", "")
        assert text[None].count("a") == 3000
    assert html_extract.extract_main_text(df.limit(0)).count() == 0


def html_texts(spark, rows):
    df = spark.createDataFrame([(i, f"http://{h}.example/{i}", html) for i, (h, html) in enumerate(rows)], "page_id long, url string, html string")
    return {x.i: x.text for x in html_extract.extract_main_text(df).select(F.col("page.page_id").alias("i"), "text").collect()}


def test_html_copies_are_no_template(spark):
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    page = lambda i, menu="": f"<body>{menu}<div><p>{own(i)}</p><p>same end {i}</p></div></body>"
    near = lambda i: f"<body><div><p>{own(0)} changed{i}</p><p>{own(900)}</p></div></body>"
    rows = [("a", page(0))] * 5 + [("a", page(i)) for i in range(1, 10)]  # copies make a third of the host
    rows += [("b", near(i)) for i in range(6)] + [("b", page(i)) for i in range(1, 13)]  # near copies
    section = len(rows)
    rows += [("c", page(1000 + i, "<div>Section menu</div>" if i < 110 else "")) for i in range(1000)]  # 11 % of a large host
    got = html_texts(spark, rows)
    assert got[0] == f"{own(0)}\n\nsame end 0"
    assert got[14] == f"{own(0)} changed0\n\n{own(900)}"
    assert got[section] == f"{own(1000)}\n\nsame end 1000"


def test_html_template_inside_articles(spark):
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    box = "<div class='box'><p>Read our letter every week.</p><ul><li>One<li>Two</ul></div>"
    page = lambda i, box=box: f"<body><article><h1>T{i}</h1><h2>Method</h2><p>{own(i)}</p>{box}<p>end {i} <i>very</i> good</p></article></body>"
    rows = [("a", page(i)) for i in range(10)]
    rows += [("b", page(0, ""))] * 6 + [("b", page(100, "").replace("w100x0 ", f"{w} ")) for w in "pqrs"]  # copies alone on a host
    got = html_texts(spark, rows)
    assert got[3] == f"T3\n\nMethod\n\n{own(3)}\n\nend 3 very good"
    assert got[10] == f"T0\n\nMethod\n\n{own(0)}\n\nend 0 very good"
    assert got[16].startswith("T100\n\nMethod\n\np w100x1") and got[16].endswith("end 100 very good")


def test_html_class_words():
    text = html_extract.main_text
    assert text("<article><h2 id='related-work'>Work</h2><section id='search-methods'><h3>Search</h3><p class='notice'>Mind this</section></article>") == "Work\n\nSearch\n\nMind this"
    assert text("<article><p>own<div class='related-posts'><a href=x>One</a> <a href=y>Two</a></div><div class='x-signup'>Mail <input></div></article>") == "own"
    assert text("<main><article class=post><p>own</article><article class=comment><p>first!</article><article class='comment-12'><p>second!</article></main>") == "own"
    assert text("<article><p>own</article><section class=related><article><p>teaser</article></section>") == "own"
    assert text("<div id=x><p>own</div><article class=comment><p>first!</article>") == "own"
    assert text("<div class=widget><article><p>own</article></div>") == "own"


def test_html_of_test_pages(spark, sf):
    import html as h
    import re

    for x in queries.op3_html_extraction(spark, sf).join(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = x.html[x.html.index("<article>") + 9 : x.html.index("</article>")].replace("<br>", " ")
        blocks = [" ".join(h.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert x.text == "\n\n".join(b for b in blocks if b) and x.n_chars == len(x.text)


def test_bpe_equals_tokenizers(spark, sf, docs):
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(queries.tokenizer_path())
    r = random.Random(11)
    letters = "ab 'stlldve\n\t\r\x0b\x1c\x85\xa0　éÉßñ日本😀́​0²½_-%$&"
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows += [(1000 + i, "".join(r.choice(letters) for _ in range(r.randint(0, 60))) + r.choice(["", "<|endoftext|>", " <|endoftext|> x"])) for i in range(400)]
    rows += [(5000, None), (5001, ""), (None, "none"), (5002, "ab" * 40_000), (5003, "z" * 3000 + " " * 3000), rows[0]]
    df = docs(rows, "doc_id long, text string, n_tokens string")
    got = bpe.encode_docs(df, queries.tokenizer_path(), with_ids=True).collect()
    assert len(got) == len(rows) and got[0].doc.n_tokens == "x"
    by_id = {x.doc.doc_id: x for x in got}
    for i, text in rows:
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        x = by_id[i]
        assert x.token_ids == ids and x.n_tokens == len(ids), text
        assert x.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256(theirs.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_docs(df.limit(0), queries.tokenizer_path()).count() == 0


def test_bpe_cuts_and_heap(spark):
    e = bpe.Encoder(bpe.load_tables(queries.tokenizer_path()))
    r = random.Random(12)
    for _ in range(300):
        data = bytes(r.choice(b"abcdefghino rstu\n\xc3\xa9") for _ in range(r.randint(1, 200)))
        parts = e.fragments(data)
        assert b"".join(parts) == data and [i for p in parts for i in e.merge(p)] == e.merge(data)
        short, bpe.SHORT = bpe.SHORT, 0
        try:
            heap = e.merge(data)
        finally:
            bpe.SHORT = short
        bpe.SHORT, keep = 1 << 30, bpe.SHORT
        try:
            assert e.merge(data) == heap
        finally:
            bpe.SHORT = keep
