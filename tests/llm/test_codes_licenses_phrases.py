"""Vector codes, licence scans and phrase collocations against plain Python, and their edge cases."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from millrace.llm import licenses, phrases, vector_codes

SPLIT = re.compile(r"[.,;:!?\x0A-\x0D]")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EDGE = [None, "", " \t\n. ;", "cc by", "é ü " * 5000, "x" * 20000, "cc  by\ncc by", "ALL rights\treserved"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def texts(spark, values, langs=("en", "de", None, "und")):
    rows = [(i if i != 2 else None, t, langs[i % len(langs)], "mine", 7) for i, t in enumerate(values)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase string, n_words int")


# Vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows]
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v in kept]
    first = [cut[k] for k in sorted(range(len(kept)), key=lambda k: kept[k][0])[:entries]]
    books = [[f[p] for f in first] for p in range(parts)]

    def near(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        members = collections.defaultdict(list)
        for c in cut:
            for p in range(parts):
                members[p, near(p, c[p])[1]].append(c[p])
        for (p, e), m in members.items():
            books[p][e] = tuple(sum(x) // len(m) for x in zip(*m))
    out = {}
    for (i, _), c in zip(kept, cut):
        best = [near(p, c[p]) for p in range(parts)]
        out[i] = ("".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best))
    return out, hashlib.sha256(",".join(str(x) for b in books for entry in b for x in entry).encode()).hexdigest()


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code string, own string")


@pytest.mark.parametrize("n, values, width", [(150, 5, 16), (40, 1000, 8), (9, 3, 24)])
def test_codes_match_plain_rounds(spark, n, values, width):
    draw = random.Random(n)
    rows = [(k, [draw.randint(-values, values) / 64 + draw.choice([0, 1e-5]) for _ in range(width)]) for k in range(n)]
    rows += [(n + k, rows[3][1]) for k in range(n // 3)]  # one vector a quarter of the rows
    table = vectors(spark, [(i, v, i % 3 if i % 5 else None, "old", "x") for i, v in rows]).repartition(5)
    found = vector_codes.compress(table).collect()
    codes, digest = plain_codes(rows)
    assert {r.vec_id: (r.code, r.error) for r in found} == codes
    assert {r.codebooks_sha256 for r in found} == {digest}
    sums = collections.Counter()
    for r in found:
        sums[r.label] += r.error
    assert all(r.label_error == sums[r.label] and r.own == "x" for r in found)


def test_codes_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [float(x) for x in range(8)]
    rows = [(None, None, 1, "", ""), (1, None, 1, "", ""), (2, [None] + good[1:], 1, "", ""), (3, [nan] + good[1:], 1, "", ""), (4, [-inf] + good[1:], 1, "", ""),
            (5, good, None, "", ""), (5, good, None, "", ""), (None, good, 2, "", ""), (7, good + good, 2, "", ""), (8, [], 2, "", ""), (9, [-0.00001] * 8, 2, "", "")]
    found = vector_codes.compress(vectors(spark, rows)).collect()
    assert sorted((r.vec_id or 0, r.code, r.error, r.label_error) for r in found if r.code) == [
        (0, "00" * 8, 0, 0), (5, "00" * 8, 0, 0), (5, "00" * 8, 0, 0), (9, "01" * 8, 0, 0)]
    assert sorted(r.vec_id for r in found if r.code is None) == [7, 8]
    assert vector_codes.compress(vectors(spark, [])).collect() == []
    assert vector_codes.compress(vectors(spark, rows[:1])).collect() == []
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(vectors(spark, [(1, [1e30] * 8, 1, "", "")])).collect()


def test_walk_shares_paths_in_any_block():
    draw = np.random.default_rng(3)
    leaves = np.unique(draw.integers(-2, 3, (700, 6)), axis=0)
    book = draw.integers(-3, 4, (5, 6))
    every = ((leaves[:, None] - book[None]) ** 2).sum(axis=2)
    for block in (1, 7, 64, 10_000):
        nearest, error = vector_codes.walk(leaves, book, block)
        assert (nearest == every.argmin(axis=1)).all() and (error == every.min(axis=1)).all()
    shuffled = leaves[draw.permutation(len(leaves))]
    assert (vector_codes.walk(shuffled, book, 9)[1] == ((shuffled[:, None] - book[None]) ** 2).sum(axis=2).min(axis=1)).all()


# Licence scans

BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}


def base_places(text):
    w = ALNUM.findall(lower(text))
    return len(w), sorted((i, i + len(p.split()), label) for i in range(len(w)) for label, p in BASE.items() if w[i : i + len(p.split())] == p.split())


def test_base_phrases_at_all_places(spark):
    draw = random.Random(5)
    bag = ["cc", "by", "CC", "general", "public", "License", "all", "rights", "reserved", "the", "é", "nc"]
    made = EDGE + ["".join(draw.choice(bag) + draw.choice([" ", "-", "\n", "_ "]) for _ in range(draw.randint(1, 60))) for _ in range(300)] + ["cc by " * 9000] + ["cc by"] * 200
    found = licenses.scan(texts(spark, made).repartition(3)).collect()
    wanted = collections.Counter((t, *map(str, base_places(t))) for t in made)
    ours = collections.Counter(
        (r.text, str(r.n_words), str(sorted((p.start, p.end, p.label) for p in r.licenses if p.base))) for r in found)
    assert ours == wanted
    assert found[0].phrase == "mine" and "n_words" in found[0].asDict()


def test_notices_need_their_key_phrases(spark):
    mit = licenses.TEMPLATES[[t.label for t in licenses.TEMPLATES].index("mit")].text
    w = mit.split()
    cases = {
        "whole": ("some code " * 50 + mit + " and more", 1.0),
        "gap": ("x " + " ".join(w[:10]) + " (one) (two) " + " ".join(w[10:]), 0.2),
        "changed": (mit.replace("charge", "cost"), None),
        "scattered": (" filler words ".join(w), None),
        "end cut": (" ".join(w[:-2]), 0.6),
    }
    rows = licenses.scan(texts(spark, [t for t, _ in cases.values()])).collect()
    found = {r.text: [(p.label, p.score) for p in r.licenses if p.label == "mit"] for r in rows}
    for name, (text, least) in cases.items():
        if least is None:
            assert found[text] == [], name
        else:
            assert found[text] and max(s for _, s in found[text]) >= least, name
    assert licenses.scan(texts(spark, [])).collect() == []


def test_rarity_counts_documents(spark):
    ix = licenses.index(licenses.TEMPLATES)
    idf = licenses.rarity(texts(spark, ["cc cc cc", "cc by", None, "none"]), ix)
    value = dict(zip(ix.vocabulary, idf))
    assert value["cc"] < value["by"] < value["reserved"] == value["gnu"]


# Phrase collocations


def plain_phrases(rows, minimum, longest=4):
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in SPLIT.split(lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(w)
            for size in range(1, longest + 1):
                counts.update((lang, tuple(w[i : i + size])) for i in range(len(w) - size + 1))
    return {k: n for k, n in counts.items() if n >= minimum}, totals


def plain_collocations(rows, minimum, top, longest=4):
    frequent, totals = plain_phrases(rows, minimum, longest)
    out = []
    for lang in totals:
        own = {p: n for (g, p), n in frequent.items() if g == lang}
        kept = []
        for p, a in own.items():
            if len(p) < 2:
                continue
            longer = [n for q, n in own.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * n >= 80 * a for n in longer):
                continue
            score, _, l, r = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


def prose(seed, n):
    draw = random.Random(seed)
    bag = ["al", "Be", "ce", "de", "é", "en the", "in the", "the", "of the new", "of", "al be ce de en"]
    return "".join(draw.choice(bag) + draw.choice([" ", " ", "  ", "\t", " ", ". ", "\n", ", "]) for _ in range(n))


@pytest.mark.parametrize("share, bits", [(1 / 8, 23), (1.0, 23), (0.0, 23), (1 / 2, 8)])
def test_phrases_match_plain_counts(spark, share, bits):
    made = EDGE + [prose(k, 80) for k in range(60)] + ["rare bird sings now. " * 40] + ["same old text here\n"] * 50
    table = texts(spark, made).repartition(4)
    rows = [(r.text, r.lang) for r in table.collect()]
    frequent, totals = plain_phrases(rows, 30)
    mined = phrases.mine(table, minimum=30, share=share, set_bits=bits)
    assert {(r.group, tuple(r.phrase.split(" "))): r.n for r in mined.phrases.collect()} == frequent
    assert {r.group: r.n for r in mined.totals.collect()} == {g: n for g, n in totals.items() if n}
    # A sample of everything proposes every frequent phrase; an empty one leaves all longer ones to the expansion.
    assert mined.passes == {1.0: 1, 0.0: 2}.get(share, mined.passes)
    found = phrases.collocations(table, top=12, minimum=30, share=share, set_bits=bits, buckets=3).collect()
    assert sorted(tuple(r) for r in found) == plain_collocations(rows, 30, 12)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(texts(spark, [])).collect() == []
    assert phrases.collocations(texts(spark, [None, "", " . "])).collect() == []
