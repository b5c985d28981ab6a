"""Each operator against plain Python on small tables, and its edge cases."""

import collections
import datetime
import hashlib
import itertools
import json
import os
import pathlib
import random
import re
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import decontamination, graph, html, mixing, neighbours, ngram_join, pii, quality_lines, repeats, text, tool_calls, url_lists

ROOT = pathlib.Path(__file__).resolve().parents[2]

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [None, "", " \n\t ", "one", "a " * 5000, "x" * 20000, "é ü\n" * 300, "same text here\n" * 30, "same text here\n" * 30]


def folded(value):
    return re.sub("[A-Z]", lambda m: m.group().lower(), value or "")


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(["an", "or", "ti", "esh", "ou", "wi"]) for _ in range(draw.randint(1, 4))) for _ in range(n))


def documents(spark, texts, **extra):
    rows = [(i if i != 3 else None, t, "en", f"s{i % 3}" if i % 7 else None, len(t or ""), "mine") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality_lines string")


@pytest.fixture(scope="module")
def edge(spark):
    return documents(spark, EDGE)


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


def near_copies():
    base = prose(1, 400)
    words = base.split()
    out = [base, base, base.upper(), prose(2, 300), prose(3, 4), prose(3, 4)]
    for k in range(12):
        copy = list(words)
        for at in range(k, len(copy), 60 - 4 * k):
            copy[at] = f"new{k}"
        out.append(" ".join(copy))
    return out + EDGE


def components_of(texts):
    sets = []
    for t in texts:
        w = WORD.findall(folded(t))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * len(sets[i] | sets[j]):
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
    return [len(s) for s in sets], root


def test_words_and_lines_match_regular_expressions():
    import pyarrow as pa

    texts = [t for t in EDGE] + [prose(k, 9) + "\n\n" + prose(k, 3) for k in range(40)]
    found, cut = [], []
    for low, high, data, offsets in text.chunks(pa.array(texts)):
        w, l = text.words(data, offsets, text.SPACED), text.lines(data, offsets)
        for i in range(high - low):
            found.append([data[a:b].tobytes().decode() for a, b in zip(w.start[w.first[i] : w.first[i + 1]], w.end[w.first[i] : w.first[i + 1]])])
            cut.append([data[a:b].tobytes().decode() for a, b in zip(l.start[l.first[i] : l.first[i + 1]], l.end[l.first[i] : l.first[i + 1]])])
    assert found == [WORD.findall(t or "") for t in texts]
    assert cut == [(t or "").split("\n") for t in texts]


def test_ngram_join_matches_all_pairs(spark):
    texts = near_copies()
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(rows).collect()}
    sizes, roots = components_of(texts)
    assert found == {i: (sizes[i], roots[i]) for i in range(len(texts))}


def test_ngram_join_counts_shared_tiles_of_large_sets(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LARGE", 50)
    test_ngram_join_matches_all_pairs(spark)


def test_ngram_join_cuts_all_tiles_into_bands(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", 1)
    test_ngram_join_matches_all_pairs(spark)


def test_ngram_join_deals_large_tiles_in_blocks(spark, monkeypatch):
    """A component that fills a tile, beside rows of other components: each pair of two components once."""
    monkeypatch.setattr(ngram_join, "DEAL", 8)
    root = {k: 1 if k <= 40 else k for k in range(1, 53)}
    rows = spark.createDataFrame([(7, k, 100, r, 52) for k, r in root.items()], "tile long, class long, n int, root long, members long")
    bits = spark.createDataFrame([(k, bytearray(64)) for k in root], "class long, bits binary")
    found = [(r.a, r.b) for r in ngram_join._banded(rows, bits, 75, nearest=False).collect()]
    assert sorted(found) == [(a, b) for a, b in itertools.combinations(root, 2) if root[a] != root[b]]
    banded = rows.select("tile", F.lit(1).alias("band"), F.lit(True).alias("own"), "class", "n", "root", "members")
    dealt = ngram_join._dealt(banded).groupBy("pair").count().collect()
    assert len(dealt) > 10 and max(r["count"] for r in dealt) < 40 and all(r.pair >= 0 for r in dealt)


def test_components_with_several_near_pairs_are_joined(spark):
    """Two groups of copies that only one of many bounded pairs joins, and copies that differ in white space."""
    words = [f"w{i}" for i in range(60)]
    texts = []
    for side, cut in enumerate((0, 7)):
        for i in range(9):
            one = list(words)
            one[cut + 3] = f"x{side}"
            one[50] = f"y{side}_{i}" if i else "both"
            texts.append("  ".join(one) if i % 2 else " ".join(one))
    texts += [t.upper() for t in texts[:4]] + [t.replace(" ", "\n") for t in texts[9:12]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(rows).collect()}
    sizes, roots = components_of(texts)
    assert found == {i: (sizes[i], roots[i]) for i in range(len(texts))}


def test_ngram_join_holds_few_rows_and_pairs(spark, monkeypatch):
    """Groups of a tile that come one after the other, pairs handed on early, rows and partners in small pieces."""
    for name, value in (("ROWS_HELD", 8), ("PAIRS_HELD", 4), ("ROWS_AT_ONCE", 3), ("PARTNERS_AT_ONCE", 4), ("SMALL_GROUP", 2)):
        monkeypatch.setattr(ngram_join, name, value)
    test_ngram_join_matches_all_pairs(spark)


def test_whole_groups_stay_whole():
    keys = [1, 1, 2, 2, 2, 2, 2, 3, 4, 4]
    batches = [pa.RecordBatch.from_pydict({"k": keys[i : i + 2], "x": list(range(i, i + 2))}) for i in range(0, 10, 2)]
    found = [t.to_pydict() for t in ngram_join._whole_groups(iter(batches), ["k"], 3)]
    assert [x for t in found for x in t["x"]] == list(range(10))
    assert sum(len(set(t["k"])) for t in found) == 4 and len(found) > 2
    assert not list(ngram_join._whole_groups(iter([]), ["k"], 3))


def test_smallest_number_of_a_large_root(spark):
    rows = spark.createDataFrame([(k, 1 if k < 900 else k // 2, 10_000 - k) for k in range(1000)], "class long, root long, least long")
    rows = rows.unionByName(spark.createDataFrame([(5000, 7000, None)], rows.schema))
    found = {r["class"]: r.component_id for r in ngram_join._least_of_root(rows).collect()}
    assert found == {**{k: 9101 if k < 900 else 10_000 - (k | 1) for k in range(1000)}, 5000: None}


def test_ngram_join_edges(spark, edge, empty):
    found = ngram_join.join(edge).collect()
    assert len(found) == len(EDGE) and ngram_join.join(empty).count() == 0
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert [by[i].n_shingles for i in (0, 1, 2)] == [0, 0, 0] and by[8].component_id == 7


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3)], "a long, b long")
    found = {r.node: r.root for r in graph.components(edges).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_personal_data(spark, edge, empty):
    texts = [
        "Mail a.b@c.de, x@y and p@q.r_s@t.uv or +1 (017) 555-7713", "ip 1.2.3.4 and 1.2.3.256 and 9.9.9.9.9.9.9.9 v",
        "card 4532015112830366 and 4532-0151-1283-0367 and 4532 0151 1283 0366", "IBAN DE89370400440532013000 ssn 123-45-6789", "sku 123-45-6789", "+12 345",
        "a@" * 3000, "1." * 3000, "7" * 5000,
    ]
    found = {r.doc_id: [(s["kind"], s["start"], s["end"]) for s in r.pii] for r in pii.mark(documents(spark, texts)).fillna(3, ["doc_id"]).collect()}
    assert [texts[0][a:b] for _, a, b in found[0]] == ["a.b@c.de", "p@q.r", "_s@t.uv", "+1 (017) 555-7713"]
    assert [texts[1][a:b] for _, a, b in found[1]] == ["1.2.3.4", "9.9.9.9", "9.9.9.9"]
    assert [texts[2][a:b] for k, a, b in found[2]] == ["4532015112830366", "4532 0151 1283 0366"]
    assert [k for k, *_ in found[3]] == ["iban", "national_id"] and not found[4] and not found[5]
    assert pii.redact("to a@b.cd now", [{"kind": "email", "start": 3, "end": 9}]) == "to <EMAIL> now"
    assert pii.mark(edge).count() == len(EDGE) and pii.mark(empty).count() == 0
    assert "quality_lines" in pii.mark(edge).columns


def test_account_numbers_before_other_words():
    number, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    for text_ in (f"{number} BIC COBADEFF", f"{spaced} 12.05.2023", f"{number} OK", f"{number} A b", f"KD12 {spaced} 0815", f"{number}, {number}"):
        assert {text_[s["start"] : s["end"]] for s in pii.find(text_) if s["kind"] == "iban"} <= {number, spaced} and pii.find(text_), text_
        assert number not in pii.redact(text_, pii.find(text_)) and spaced not in pii.redact(text_, pii.find(text_))
    assert [(s["start"], s["end"]) for s in pii.find("NO9386011117947 GB82 WEST 1234 5698 7654 32 X")] == [(0, 15), (16, 43)]
    # A code without a registered length: the longest end at a border that passes.
    other = "ZZ" + f"{98 - int('1234567890123' + '3535' + '00') % 97:02d}" + "1234567890123"
    assert [(s["start"], s["end"]) for s in pii.find(f"{other} UND")] == [(0, len(other))]
    assert not pii.find(f"{number}0") and not pii.find(f"{number}x") and not pii.find("DE88370400440532013000 OK")


def test_quality_counts(spark, edge, empty):
    texts = EDGE + ["a b c a b c # $", "l one\nl one\n\nl one", prose(5, 80)]
    model = quality_lines.Model(np.zeros((2, len(quality_lines.FEATURES))), np.zeros((2, 2)))
    found = quality_lines.label_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for row in found:
        t = texts[row.doc_id] or ""
        w, q = WORD.findall(t), row.quality_lines
        grams = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = {i + k for i in range(len(w) - 2) for k in range(3) if grams[tuple(w[i : i + 3])] > 1}
        full = [x for x in t.split("\n") if WORD.search(x)]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(full) - len(set(full)), len(again))
        assert q.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and q.kept == (not q.base_failed)
    assert quality_lines.label_documents(edge, model).count() == len(EDGE)
    assert quality_lines.label_documents(empty, model).count() == 0


def test_viterbi_matches_all_sequences():
    draw = np.random.default_rng(3)
    transition, first = draw.normal(size=(2, 2)), np.array([0, 4, 4, 5, 11])
    scores = draw.normal(size=(11, 2))
    best = []
    for a, b in zip(first[:-1], first[1:]):
        if b > a:
            best += max(itertools.product((0, 1), repeat=int(b - a)), key=lambda y: sum(scores[a + i, l] for i, l in enumerate(y)) + sum(transition[i, j] for i, j in zip(y, y[1:])))
    assert quality_lines.viterbi(scores, first, transition).tolist() == best


def test_quality_model_learns_junk(spark):
    good = [prose(k, 80) + "." for k in range(40)]
    bad = [" ".join(w + "###" for w in prose(100 + k, 80).split()) for k in range(40)]
    rows = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)], "doc_id long, quality int")
    model = quality_lines.fit(rows, labels)
    kept = {r.doc_id for r in quality_lines.label_documents(rows, model).filter("quality_lines.kept").collect()}
    assert kept == set(range(40))
    scored = neighbours.score(rows, neighbours.fit(rows, labels)).collect()
    assert all((r.score >= 0.3) == (r.doc_id < 40) for r in scored)


def mixed_texts():
    """Clean documents with some junk lines, and junk with some clean lines."""
    junk = lambda k: " ".join(w + "###" for w in prose(k, 12).split())
    clean = lambda k: prose(k, 12) + "."
    good = ["\n".join(junk(9000 + 10 * k + i) if i in (2, 3) else clean(10 * k + i) for i in range(8)) for k in range(40)]
    bad = ["\n".join(clean(5000 + 10 * k + i) if i in (5, 6) else junk(7000 + 10 * k + i) for i in range(8)) for k in range(40)]
    return good, bad


def test_mixed_documents_get_a_share_between_none_and_all(spark):
    good, bad = mixed_texts()
    rows = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(good + bad)], "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{i}", int(i < 40)) for i in range(80)], "doc_id string, quality int")
    model = quality_lines.fit(rows, labels)
    found = {int(r.doc_id[1:]): r.quality_lines for r in quality_lines.label_documents(rows, model).collect()}
    assert all(0.6 < found[i].content_share < 1 and found[i].kept for i in range(40))
    assert all(0 < found[i].content_share < 0.4 and not found[i].kept for i in range(40, 80))


def test_labels_of_lines():
    """The lines that agree least change their label, unless others hold half of the characters or less."""
    emission = np.array([[0.0], [1.0]])
    lines = [np.array([[2.0], [-1.0], [3.0]]), np.array([[2.0], [-1.0], [3.0]]), np.array([[-1.0], [-2.0]])]
    chars = [np.array([10.0, 5.0, 10.0])] * 2 + [np.array([10.0, 10.0])]
    found = quality_lines.line_labels(lines, chars, np.array([1, 0, 1]), emission)
    assert [x.tolist() for x in found] == [[1, 0, 1], [0, 0, 1], [1, 1]]


def test_lines_after_the_first_pieces_are_learnt(spark, monkeypatch):
    """Junk that stands only late in long texts; pieces of the sequences are short."""
    monkeypatch.setattr(quality_lines, "PIECE", 4)
    clean = [prose(k, 10) + "." for k in range(3000)]
    junk = [" ".join(w + "$$$" for w in prose(k, 40).split()) for k in range(400)]
    good = ["\n".join(clean[60 * k : 60 * k + 60]) for k in range(20)]
    bad = ["\n".join(clean[1200 + 50 * k : 1250 + 50 * k] + junk[20 * k : 20 * k + 20]) for k in range(20)]
    rows = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    model = quality_lines.fit(rows, spark.createDataFrame([(i, int(i < 20)) for i in range(40)], "doc_id long, quality int"))
    found = {r.doc_id: r.quality_lines for r in quality_lines.label_documents(rows, model).collect()}
    assert all(found[i].content_share > 0.9 for i in range(20)) and all(0.1 < found[i].content_share < 0.5 for i in range(20, 40))


@pytest.mark.parametrize("run", [quality_lines.analyse, neighbours.terms, ngram_join._sets, text.hashes], ids=lambda f: f.__qualname__)
def test_functions_are_loaded_without_the_library(run, tmp_path):
    """What travels to executors can be read by a process that doesn't find the library."""
    (tmp_path / "run").write_bytes(cloudpickle.dumps(run))
    code = f"import pickle, sys; sys.path[:] = [p for p in sys.path if p != {str(ROOT)!r}]; f = pickle.load(open('run', 'rb')); assert callable(f) and 'millrace' not in sys.modules"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=60)


def test_neighbour_edges(spark, edge, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = neighbours.fit(edge, labels)
    found = neighbours.score(edge, model).collect()
    assert len(found) == len(EDGE) and all(0 <= r.score <= 1 for r in found)
    assert neighbours.score(empty, neighbours.fit(edge, labels.union(spark.createDataFrame([(1, 1), (4, 0), (5, 1)], "doc_id long, quality int")))).count() == 0


def test_leaks_match_windows(spark, edge, empty):
    item, short = prose(9, 25), "zu kurz hier"
    bench = spark.createDataFrame([(1, item), (2, short), (3, None), (4, "..."), (5, item), (5, item)], "item_id long, text string")
    texts = [prose(20, 30) + " " + item + " " + prose(21, 5), "nun ZU kurz, hier!", " ".join(item.split()[:9]), "x " + " ".join(item.split()[3:13]) + " y", None, ""]
    found = {r.doc_id: r for r in decontamination.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bench).collect()}
    assert [(found[i].n_words, found[i].n_hit, found[i]["items"]) for i in range(6)] == [
        (60, 25, ["1", "5"]), (4, 3, ["2"]), (9, 0, []), (12, 10, ["1", "5"]), (0, 0, []), (0, 0, [])]
    assert decontamination.judge(edge, bench).count() == len(EDGE)
    assert decontamination.judge(empty, bench).count() == 0 and decontamination.judge(edge, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_mix_meets_targets_and_reruns(spark, edge, empty):
    draw = random.Random(5)
    rows = [(i, f"s{min(i % 10, 4)}" if i % 11 else None, draw.randint(0, 400)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    runs = [sorted((r.doc_id, r.size, r.copies) for r in mixing.mix(frame, block=200).collect()) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)
    size = collections.Counter()
    for _, s, n in rows:
        size[s] += n
    names = sorted(s for s in size if s) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, stopped, total = {}, set(), 1.5 * sum(size.values())
    while True:
        level = (total - sum(2 * size[s] for s in stopped)) / sum(weight[s] for s in names if s not in stopped)
        more = {s for s in names if s not in stopped and weight[s] * level >= 2 * size[s]}
        if not more:
            break
        stopped |= more
    target = {s: 2 * size[s] if s in stopped else weight[s] * level for s in names}
    taken = collections.Counter()
    for (i, n, copies), (_, s, _) in zip(runs[0], rows):
        assert copies <= 2
        taken[s] += n * copies
    for s in names:
        assert abs(taken[s] - target[s]) <= 0.01 * target[s] + 5
    assert mixing.mix(edge).count() == len(EDGE) and mixing.mix(empty).count() == 0


def test_flight_keeps_balance():
    draw = np.random.default_rng(1)
    p, x = np.full(300, 0.3), draw.integers(1, 500, 300).astype(float)
    out = mixing.flight(p, x, np.random.default_rng(2), landing=False)
    assert ((out > 0) & (out < 1)).sum() <= 2 and abs((out - p).sum()) < 1e-6 and abs(((out - p) * x).sum()) < 1e-3


def test_repeats_match_all_windows(spark, edge, empty):
    shared, other = prose(50, 120), prose(51, 60)
    texts = [prose(1, 90) + shared + prose(2, 90), shared, prose(3, 40) + shared[60:], other, other, "ab" * 400, prose(4, 30), None, "", "é" * 150, prose(60, 30) + "é" * 260]
    raw = [(t or "").encode() for t in texts]
    counts = collections.Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    found = {r.doc_id: r for r in repeats.remove(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, b in enumerate(raw):
        gone = np.zeros(len(b), dtype=bool)
        for k in range(len(b) - 199):
            if counts[b[k : k + 200]] > 1:
                gone[k : k + 200] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        assert sum(r.end - r.start for r in found[i].removed) == gone.sum(), i
        assert found[i].kept_sha256 == hashlib.sha256(kept).hexdigest() and found[i].n_bytes == len(b)
    assert repeats.remove(edge).count() == len(EDGE) and repeats.remove(empty).count() == 0


def test_repeats_of_an_anchor_with_many_contexts(spark, monkeypatch):
    shared, tail = prose(50, 120), prose(52, 50)
    texts = [prose(100 + i, 40) + shared + (tail if i % 5 == 0 else prose(200 + i, 40)) for i in range(40)] + [shared + "!"] * 2
    raw = [t.encode() for t in texts]
    counts = collections.Counter(b[i : i + 200] for b in raw for i in range(len(b) - 199))
    monkeypatch.setattr(repeats, "INDEX_BYTES", 4000)

    def bounded(parts, length, matches=repeats.long_matches):
        assert sum(map(len, parts)) <= 4000, "an index over the bound"
        return matches(parts, length)

    monkeypatch.setattr(repeats, "long_matches", bounded)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: [(x.start, x.end) for x in r.removed] for r in repeats.remove(frame).collect()}
    for i, b in enumerate(raw):
        want = [[k, k + 200] for k in range(len(b) - 199) if counts[b[k : k + 200]] > 1]
        assert found[i] == [tuple(x) for x in repeats._merged(want)], i


def test_long_matches_of_an_index():
    draw = random.Random(8)
    parts = [bytes(draw.choice(b"ab") for _ in range(40)) for _ in range(6)]
    counts = collections.Counter(p[i : i + 7] for p in parts for i in range(len(p) - 6))
    want = [len(p[i : i + 7]) == 7 and counts[p[i : i + 7]] > 1 for p in parts for i in range(len(p))]
    assert repeats.long_matches(parts, 7).tolist() == want


def test_main_text(spark):
    page = (
        "<html><head><title>T</title><script>var a='</p>';</script></head><body><header>Site</header><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><article><h1>A &amp; B</h1><p><b>First<br>  line<p>Second <i>part</i> &#233;.</p>"
        "<div class='share'>Share</div><section id=comments><p>Nice</p></section></article><aside>Side</aside><form>Name</form><footer>Foot</footer></body></html>")
    assert html.main_text(page) == "A & B\nFirst line\nSecond part é."
    assert html.main_text(None) == "" and html.main_text("") == "" and html.main_text("plain <b>text") == "plain text"
    assert html.main_text("<p>a<!-- open") == "a" and html.main_text("<div>" * 3000 + "deep") == "deep"
    own = "".join(f"<html><body><div class=x><p>every page says this</p></div><div><p>{{}}</p></div></body></html>" for _ in range(1))
    rows = [(i, "http://h.example/p", own.format(prose(i, 20))) for i in range(40)] + [(40, None, "<p>no host</p>"), (41, "http://h.example/q", None)]
    found = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {**{i: prose(i, 20) for i in range(40)}, 40: "no host", 41: ""}
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string, text string")).count() == 0


def test_list_join(spark):
    day = lambda n: datetime.date(2024, 1, n)
    log = spark.createDataFrame([
        ("domain", "bad.example", day(3), "add"), ("domain", "bad.example", day(3), "add"), ("domain", "bad.example", day(10), "remove"),
        ("domain", "bad.example", day(20), "add"), ("prefix", "ok.example/x", day(1), "add"), ("url", "ok.example/y?q=1", day(5), "add"),
        ("domain", "other.example", day(2), "remove"), (None, "z", day(1), "add"), ("domain", "late.example", None, "add"),
    ], "kind string, key string, listed_on date, action string")
    rows = [
        (1, "http://a.bad.example/p", day(2)), (2, "https://u:p@A.BAD.example.:80/p", day(3)), (3, "http://bad.example", day(10)), (4, "http://bad.example", day(25)),
        (5, "http://ok.example/x/z?k", day(9)), (6, "http://ok.example/y?q=1#top", day(5)), (7, "http://notbad.example", day(5)), (8, None, day(5)), (9, "nonsense", day(5)),
        (10, "http://bad.example", None), (4, "http://bad.example", day(25)),
    ]
    captures = spark.createDataFrame(rows, "id long, url string, fetched_on date").withColumn("matches", F.lit("mine"))
    found = sorted((r.id, tuple(r.matches)) for r in url_lists.judge(captures, log).collect())
    bad = ("domain:bad.example",)
    assert found == [(1, ()), (2, bad), (3, ()), (4, bad), (4, bad), (5, ("prefix:ok.example/x",)), (6, ("url:ok.example/y?q=1",)), (7, ()), (8, ()), (9, ()), (10, ())]
    assert url_lists.judge(captures.limit(0), log).count() == 0 and url_lists.judge(captures, log.limit(0)).filter("size(matches) > 0").count() == 0


def test_tool_calls(spark):
    calls = spark.createDataFrame([
        ("c", "1", "f", '{"b": 1, "a": "x"}', None), ("c", "1", "f", '{"b": 1, "a": "x"}', None), ("c", "2", "f", '{"a": 5}', "1"), ("c", "3", "g", "{}", "2"),
        ("c", "4", "f", "not json", "3"), ("c", "5", "f", None, "none"), ("d", "6", "f", '{"a":"y","z":{"q":[2, 1]}}', "7"), ("d", "7", "f", '{"a":"y"}', "6"), (None, None, "f", "{}", None),
        *[("e", f"n{i}", "f", '{"a":""}', f"n{i - 1}" if i else None) for i in range(20)],
    ], "conv_id string, call_id string, name string, arguments string, after string")
    results = spark.createDataFrame([("1", "done"), ("1", "done"), ("9", "lost"), (None, "x")], "call_id string, output string")
    schemas = spark.createDataFrame([("f", "a", "string", True), ("f", "b", "integer", False)], "name string, field string, type string, required boolean")
    found = {r.call_id: r for r in tool_calls.link(calls, results, schemas).collect()}
    assert [found[k].level for k in "1234567"] == [0, 1, 2, 3, 0, None, None] and [found[f"n{i}"].level for i in range(20)] == list(range(20))
    assert found["1"].valid and found["1"].n_rows == 2 and found["1"].n_results == 2
    assert json.loads(found["1"].json) == {"arguments": {"a": "x", "b": 1}, "id": ["1"], "name": ["f"], "result": ["done"]}
    assert found["1"].json.startswith('{"arguments":{"a":"x","b":1},"id"')
    assert {k: found[k].problems for k in "23456"} == {"2": ["type:a"], "3": ["no_schema"], "4": ["not_an_object"], "5": ["not_an_object"], "6": ["unknown:z"]}
    assert found["5"].dangling and not found["2"].dangling
    # Results without a call, and results that differ.
    assert found["9"].problems == ["no_call"] and (found["9"].n_rows, found["9"].n_results, found["9"].output, found["9"].json) == (0, 1, "lost", None)
    assert not found["9"].valid and not found["9"].dangling and found["9"].level is None and found["2"].n_outputs == 0
    several = spark.createDataFrame([("2", "b", 1), ("2", "a", 2), ("2", "b", 3), ("2", None, 4)], "call_id string, output string, level int")
    by = {r.call_id: r for r in tool_calls.link(calls.withColumn("json", F.lit(1)), several, schemas).collect()}
    assert (by["2"].output, by["2"].n_results, by["2"].n_outputs, by["2"].level) == ("a", 4, 3, 1) and by["1"].n_results == 0 and "9" not in by
    assert [(r.call_id, r.problems) for r in tool_calls.link(calls.limit(0), several, schemas).collect()] == [("2", ["no_call"])]
    results = results.limit(0)
    assert tool_calls.link(calls.limit(0), results, schemas).count() == 0


def test_pipeline_stages(spark, tmp_path):
    clean = [prose(k, 90) + "." for k in range(60)]
    junk = [" ".join(w + "$$$" for w in prose(300 + k, 90).split()) for k in range(30)]
    item = prose(999, 15)
    texts = clean + junk + [clean[0], clean[1] + " more", prose(500, 60) + " " + item + " " + prose(501, 10), prose(502, 60) + " write to a@b.cd.", None, ""]
    rows = [(i, t, "en", f"s{i % 2}", len(t or ""), "extra") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row_key string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 60)) for i in range(90)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen, now = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{n}")
        now = spark.read.parquet(f"{tmp_path}/{n}")
        seen[name] = now.collect()
        if n < 4:
            assert now.columns == docs.columns
    ids = {name: {r.doc_id for r in rows} for name, rows in seen.items()}
    assert ids["quality_rules"] == set(range(60)) | {90, 91, 92, 93}
    assert ids["near_duplicates"] == set(range(60)) | {92, 93} and len(seen["near_duplicates"]) == 62
    assert ids["decontaminate"] == set(range(60)) | {93}
    assert next(r.text for r in seen["personal_data"] if r.doc_id == 93).endswith("write to <EMAIL>.")
    assert {r.copy for r in seen["source_mix"]} <= {1, 2} and len(seen["source_mix"]) > 61
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(seen["source_mix"])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
