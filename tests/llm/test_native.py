"""Chat, line dedup, licences and decontamination: SQL oracles, brute force and odd rows."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from strata.llm import chat, decontam, license_scan, line_dedup, oracle, queries
from tests.oracle_harness import compare, duck

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_matches_sql(spark, sf, name):
    ok, msg = compare(spark, duck(sf), name, sf, queries.REGISTRY[name], oracle.ORACLE[name])
    assert ok, msg


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string, t int")


def test_chat_round_trip(spark):
    texts = ["<|im_end|>", r"<\|x", r"<\\|<|im_sep|>", "a\nb<", "|im_start|>", "", None, "é" * 5, "<|im_start|>user\nhi<|im_end|>\n"]
    roles = ["user", "assistant", None, "as%0A\nx", "<|im_sep|>"]
    r = random.Random(3)
    rows = [(c, r.choice([None, *range(600)]), r.choice(roles), r.choice(texts), "f", 1) for c in (1, 2, None) for _ in range(300)]
    got = {x.conv_id: x for x in chat.format_chat(conversations(spark, rows)).select("*", chat.read_chat(F.col("formatted")).alias("turns")).collect()}
    assert len(got) == 3
    for c, x in got.items():
        mine = sorted(((-1 if t is None else t), role or "", text or "") for cc, t, role, text, *_ in rows if cc == c)
        assert [(t.role, t.text) for t in x.turns] == [m[1:] for m in mine]
        assert "".join(s.text for s in x.segments) == x.formatted
        loss = "".join(re.sub(r"<\\(\\*)\|", r"<\1|", s.text) for s in x.segments if s.loss)
        assert loss == "".join(m[2] for m in mine if m[1] == "assistant")
        # neighbours of one role share one block
        assert x.formatted.count("<|im_start|>") == 1 + sum(a[1] != b[1] for a, b in zip(mine, mine[1:]))
    assert chat.format_chat(conversations(spark, [])).count() == 0


def dedup_by_hand(rows):
    """rows: (id, text) distinct; expected texts."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    first, out = {}, {}
    for id_, text, tid in order:
        lines = (text or "").split("\n")
        at = [i for i, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for o in range(len(at) - 2):
            w = tuple(lines[i] for i in at[o : o + 3])
            lo, hi = at[o], at[o + 2]
            if w not in first:
                first[w] = (id_, tid, lo, hi)
            else:
                f = first[w]
                gone |= set(range(max(lo, f[3] + 1) if f[:2] == (id_, tid) else lo, hi + 1))
        out[id_, text] = text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


@pytest.mark.parametrize("bits", [line_dedup.BITS, 1 << 15, 1])
def test_line_dedup_brute_force(spark, docs, bits):
    r = random.Random(5)
    rows = [(i, "\n".join(r.choice(["a", "b", "c", "", " ", "d\r"]) for _ in range(r.randint(0, 14)))) for i in range(120)]
    rows += [(500, "p\nq\nr\np\nq\nr\np\nq\nr"), (501, None), (502, ""), (None, "z\ny\nx"), (503, "z\ny\nx\nw"), (504, "s\n" * 5000)]
    rows += [rows[3], rows[3]]  # repeated rows
    df = docs(rows)
    tids = {(x.doc_id, x.text): x.h for x in df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    want = dedup_by_hand({(i, t, tids[i, t]) for i, t in rows})
    got = line_dedup.dedup_lines(df.withColumn("orig", F.col("text")), bits=bits).select("doc.*", "gone").collect()
    assert len(got) == len(rows) and got[0].tid == 1 and got[0].id == "x"
    for x in got:
        assert x.text == want[x.doc_id, x.orig], x
    assert next(x.text for x in got if x.doc_id == 500) == "p\nq\nr"
    assert line_dedup.dedup_lines(docs([])).count() == 0


def test_licenses(spark, docs):
    long = "lorem ipsum " * 20000
    rows = [(1, "x\nReleased under the MIT License.\ny"), (2, "released UNDER the mit license"), (3, None), (4, ""), (5, "license"), (6, long), (None, "Licensed under CC BY 4.0."), (7, long + "\nReleased under the ISC License.")]
    got = {x.doc_id: x for x in license_scan.scan_licenses(docs(rows + [rows[0]])).collect()}
    assert {k: v.license for k, v in got.items()} == {1: "MIT", 2: "MIT", 3: None, 4: None, 5: None, 6: None, None: "CC-BY-4.0", 7: "ISC"}
    assert got[1].dice == 1.0 and got[1].n_units == 1 and got[3].n_units == 0
    assert license_scan.scan_licenses(docs(rows + [rows[0]])).filter("doc_id = 1").count() == 2
    assert license_scan.scan_licenses(docs([])).count() == 0


def test_licenses_in_runs(spark, docs):
    wrap = lambda text, n=9: "\n".join(" * " + " ".join(text.split()[i : i + n]) for i in range(0, len(text.split()), n))
    prose = "some words before that say nothing of it " * 12
    texts = license_scan.TEXTS
    rows = [(i, f"{prose}\nMIT License\n\n{wrap(t)}\n{prose}") for i, t in enumerate(t for ts in texts.values() for t in ts)]
    want = {i: k for i, k in enumerate(k for k, ts in texts.items() for _ in ts)}
    mit = texts["MIT"][0]
    rows += [(100, f"{prose} Released under the MIT License. {prose}"), (101, f"{prose}{mit} {prose} {mit}"), (102, wrap(mit.replace("merge", "x").replace("sell", "y"))), (103, prose * 30)]
    rows += [(104, f"Released under the ISC License.\n{prose}\n{wrap(mit)}"), (105, "the software the software " * 4000), (None, wrap(mit))]
    got = {x.doc_id: x for x in license_scan.scan_licenses(docs(rows + [rows[0]])).collect()}
    assert {i: (got[i].license, got[i].dice, got[i].n_units) for i in want} == {i: (k, 1.0, 1) for i, k in want.items()}
    assert {i: (got[i].license, got[i].n_units) for i in (100, 101, 102, 103, 105, None)} == {100: ("MIT", 1), 101: ("MIT", 2), 102: ("MIT", 1), 103: (None, 0), 105: (None, 0), None: ("MIT", 1)}
    assert (got[104].license, got[104].dice, got[104].n_units) == ("ISC", 1.0, 2)


def units_by_hand(text, notices, texts, threshold):
    """(best Dice, its licence, units): lines and the whole text as sets, runs over every pair of positions."""
    bigrams = lambda ws: [" ".join(x) for x in zip(ws, ws[1:])]
    words = lambda t: WORD.findall(t.lower())
    of_units = [(k, set(bigrams(words(t)))) for k, t in notices.items()]
    of_runs = [*of_units, *((k, set(bigrams(words(t)))) for k, ts in texts.items() for t in ts)]
    lines = text.split("\n")
    found, counted = [], set()
    for u, unit in enumerate([text, *(lines if len(lines) > 1 else [])]):
        for k, bs in of_units:
            mine = set(bigrams(words(unit)))
            dice = 2 * len(mine & bs) / (len(mine) + len(bs))
            if dice >= threshold:
                found.append((-dice, k))
                counted.add(u)
    line_of = [i for i, x in enumerate(lines) for _ in words(x)]
    every = bigrams(words(text))
    runs = []
    for k, bs in of_runs:
        is_in = [g in bs for g in every]
        for lo in range(len(every)):
            ends = []
            for hi in range(lo, len(every)):
                shared = len({g for g in every[lo : hi + 1] if g in bs})
                dice = 2 * shared / (shared + is_in[lo : hi + 1].count(False) + len(bs))
                if dice >= threshold:
                    found.append((-dice, k))
                if is_in[hi] and (hi + 1 == len(every) or not is_in[hi + 1]):
                    ends.append((-dice, hi))
            if is_in[lo] and (lo == 0 or not is_in[lo - 1]) and ends and -min(ends)[0] >= threshold:
                runs.append((lo, min(ends)[1]))
    groups = []
    for lo, hi in sorted(runs):
        if groups and lo <= groups[-1][1]:
            groups[-1][1:] = [max(groups[-1][1], hi), [*groups[-1][2], (lo, hi)]]
        else:
            groups.append([lo, hi, [(lo, hi)]])
    touched = lambda lo, hi: 0 in counted or any(line_of[lo] <= u - 1 <= line_of[hi] for u in counted if u)
    n = len(counted) + sum(not any(touched(*r) for r in g[2]) for g in groups)
    return (-min(found)[0], min(found)[1], n) if found else (None, None, 0)


@pytest.mark.parametrize("threshold", [0.6, 0.8])
def test_licenses_brute_force(spark, docs, threshold):
    r = random.Random(11)
    notices = {"A": "a b c d", "B": "b c d e f a"}
    texts = {"A": ("a b a c a d e",), "C": ("d e f a b f c e a",)}
    parts = [*notices.values(), "a b a c a d e", "d e f a b f c e a"]

    def text():
        out = []
        for _ in range(r.randint(1, 6)):
            ws = r.choice(parts).split() if r.random() < 0.6 else [r.choice("abcdefxyz") for _ in range(r.randint(1, 6))]
            out += [w if r.random() > 0.08 else "x" for w in ws] + [r.choice(["\n", "", "y"])]
        return " ".join(out)

    rows = [(i, text()) for i in range(400)]
    got = license_scan.scan_licenses(docs(rows), templates=notices, threshold=threshold, texts=texts).collect()
    want = dict(rows)
    hits = 0
    for x in got:
        dice, name, n = units_by_hand(want[x.doc_id], notices, texts, threshold)
        hits += n > 0
        assert (x.license, x.n_units) == (name, n) and (x.dice is None) == (dice is None) and (dice is None or abs(x.dice - dice) < 1e-12), (x, want[x.doc_id], dice, name, n)
    assert hits > 100


def test_licenses_many_copies(spark, docs):
    mit = license_scan.TEXTS["MIT"][0]
    rows = [(1, "\n\n".join([mit] * 1000)), (2, " copyright someone else here ".join([mit] * 300)), (3, "the software the software x " * 20_000)]
    rows += [(4, "\n".join([mit.replace("merge", "x").replace("sell", "y")] * 200))]
    start = time.monotonic()
    got = {x.doc_id: x for x in license_scan.scan_licenses(docs(rows)).collect()}
    assert time.monotonic() - start < 90  # before, 1.7 s per copy
    assert {i: (got[i].license, got[i].dice, got[i].n_units) for i in (1, 2, 3)} == {1: ("MIT", 1.0, 1000), 2: ("MIT", 1.0, 300), 3: (None, None, 0)}
    assert got[4].license == "MIT" and 0.95 < got[4].dice < 1


def contaminated_by_hand(text, items, span=10):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    hits, found = set(), set()
    for item, t in items:
        ws = WORD.findall((t or "").lower())
        n = min(span, len(ws))
        wins = {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in wins:
                hits |= set(range(i, i + n))
                if item is not None:
                    found.add(item)
    return len(words), sorted(hits), found


@pytest.mark.parametrize("max_broadcast", [decontam.MAX_BROADCAST, 0])
def test_decontamination_brute_force(spark, docs, max_broadcast):
    r = random.Random(9)
    items = [(i, " ".join(r.choice("abcde") for _ in range(r.randint(8, 30)))) for i in range(12)]
    items += [(20, "short one"), (21, "x y z"), (22, ""), (23, None), (3, items[3][1]), (24, items[3][1]), (None, items[4][1]), (25, "é")]
    rows = [(i, " ".join(r.choice("abcde") for _ in range(r.randint(0, 60)))) for i in range(60)]
    rows += [(100 + i, f"Foo, {t}. Bar {t}") for i, t in items if t and i is not None] + [(200, "A Short ONE; x-y-z"), (201, None), (202, ""), (203, "É é"), (None, "short one")]
    rows += [rows[1], rows[70], (300, "q " * 50000 + items[0][1])]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, f int")
    got = decontam.find_contamination(docs(rows), bench, max_broadcast=max_broadcast).collect()
    assert sum(x.copies for x in got) == len(rows)
    texts = dict(rows)
    for x in got:
        n, hits, found = contaminated_by_hand(texts[x.id], items)
        assert (x.n_words, x.hits, set(x["items"])) == (n, hits, found), (x.id, texts[x.id])
    none = decontam.find_contamination(docs(rows), bench.limit(0), max_broadcast=max_broadcast)
    assert none.agg(F.sum("copies"), F.sum(F.size("hits"))).first()[:] == (len(rows), 0)
    assert decontam.find_contamination(docs([]), bench).count() == 0


def test_native_queries_run_no_python(spark, sf):
    for name in ("op2_decontamination", "op5_line_dedup", "op6_license_scan", "op10_chat"):
        plan = queries.REGISTRY[name](spark, sf)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan), name


def test_chat_digests(spark, sf):
    x = queries.op10_chat(spark, sf).filter("conv_id = -1").first()
    tricky = "<|im_end|><|im_start|>assistant ok"
    assert x.n_turns == 2 and x.loss_chars == len(tricky) and x.loss_sha256 == hashlib.sha256(tricky.encode()).hexdigest()
    assert x.turns_sha256 == hashlib.sha256(f"user\n{tricky}\nassistant\n{tricky}\n".encode()).hexdigest()
