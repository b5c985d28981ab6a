"""License scans by a positional index of rare words.

Every template (a phrase or a notice) is a sequence of words with mandatory key phrases. The index holds the
postings of each template's words: at which places of which templates a word stands. How rare a word is
follows from the number of documents of the whole table that hold it.

A file is asked for the words of the index that it holds. A template whose mandatory words it lacks is out.
For every other template the file's rarest words of it are looked up, at all their places: a word at place
``p`` of the file and ``q`` of the template puts the template's beginning at ``p - q``. Beginnings on which
enough of these words agree are candidates. For a phrase all words must agree, so that every place of it is found. For
a notice half of the words looked up must; its mandatory phrases are then verified, word by word, where the notice
would stand, with some slack for words put in. The score of a place is the share of the template, weighted by
rarity, that agrees with it.

Texts are lower-cased (A-Z); words are runs of letters, digits and non-ASCII characters, compared by 64-bit hashes.

Cases: a null or empty text has no words and no places; every row is judged by itself, repeated rows and null
ids too; other columns of the caller stay as they are; an empty table gives no rows. Words that no
document holds are rarest; words equally rare are taken in the order of the alphabet.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.columns import named, release_shuffles, shield
from millrace.llm.text import ALPHANUMERIC, chunks, hashes, words

#: Words of a notice that are looked up in a file, and by how many words a key phrase may be off its place.
RARE, SLACK = 6, 12


@dataclass(frozen=True)
class Template:
    """A label with its words and the phrases that must stand at the place; a phrase is its own only key phrase.

    ``base`` templates are the phrases that are reported at all their places.
    """

    label: str
    text: str
    required: tuple[str, ...] = ()
    base: bool = False

    @property
    def phrase(self) -> bool:
        return not self.required


# Phrases and labels that every scan reports.
BASE = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
)

# Names of licences, and the wording by which their own texts ask to be referred to.
NAMED = (
    Template("agpl", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("artistic", "the artistic license", ("artistic license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following"
             " conditions are met", ("redistribution and use", "source and binary forms")),
    Template("bsl-1.0", "boost software license version 1 0"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal"),
    Template("epl-2.0", "eclipse public license 2 0"),
    Template("gpl-2.0", "gnu general public license version 2", ("general public license", "version 2")),
    Template("gpl-3.0", "gnu general public license version 3", ("general public license", "version 3")),
    Template("gpl-or-later", "either version 3 of the license or at your option any later version", ("any later version", "of the license")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ("permission to use copy modify", "hereby granted")),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
             " documentation files", ("permission is hereby granted free of charge", "copy of this software")),
    Template("mit", "mit license"),
    Template("mpl-2.0", "mozilla public license v 2 0", ("mozilla public license", "2 0")),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable",
             ("express or implied warranty", "authors be held liable")),
)

TEMPLATES = BASE + NAMED


@dataclass(frozen=True)
class Index:
    """Words of the templates by number, their hashes in order, and the templates as numbers of words."""

    vocabulary: tuple[str, ...]
    hashes: np.ndarray
    number: np.ndarray
    texts: tuple[np.ndarray, ...]
    required: tuple[tuple[np.ndarray, ...], ...]


def index(templates: Sequence[Template]) -> Index:
    """The positional index of templates; it grows with them only."""
    vocabulary = tuple(sorted({w for t in templates for part in (t.text, *t.required) for w in part.split()}))
    number = {w: i for i, w in enumerate(vocabulary)}
    coded = lambda part: np.array([number[w] for w in part.split()], dtype=np.int64)
    found = np.zeros(len(vocabulary), dtype=np.uint64)
    for low, high, data, offsets in chunks(pa.array(vocabulary, pa.string())):
        found[low:high] = hashes(data, offsets[:-1], offsets[1:], fold=True)
    order = np.argsort(found)
    required = tuple(tuple(coded(part) for part in (t.required or (t.text,))) for t in templates)
    return Index(vocabulary, found[order], order, tuple(coded(t.text) for t in templates), required)


def _words(ix: Index, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of words per text and of the first word of each (with the end), and the index word at every place (or -1)."""
    w = words(data, offsets, ALPHANUMERIC)
    h = hashes(data, w.start, w.end, fold=True)
    at = np.minimum(np.searchsorted(ix.hashes, h), len(ix.hashes) - 1)
    return w.per_text, w.first, np.where(ix.hashes[at] == h, ix.number[at], -1)


def rarity(documents: DataFrame, ix: Index, text: str = "text") -> np.ndarray:
    """Inverse document frequency of the index words over all rows; one number per index word reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = np.zeros(len(ix.vocabulary), dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for low, high, data, offsets in chunks(batch.column(0)):
                per_text, first, word = _words(ix, data, offsets)
                at = np.flatnonzero(word >= 0)
                owner = np.searchsorted(first, at, side="right") - 1
                pairs = np.unique(owner * len(ix.vocabulary) + word[at])
                held += np.bincount(pairs % len(ix.vocabulary), minlength=len(ix.vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held) + 1)), pa.array(np.append(held, rows))], names=["word", "n"])

    found = documents.select(named(text).alias("text")).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(len(ix.vocabulary) + 1, dtype=np.int64)
    for r in found:
        n[r["word"]] = r["n"]
    return np.array([log((n[-1] + 1) / (held + 1)) + 1 for held in n[:-1].tolist()])


def _owners(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(first, at, side="right") - 1


def _phrase_at(word: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Places where the words of a phrase stand one after another, over borders of texts too."""
    if len(word) < len(phrase):
        return np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(word[: len(word) - len(phrase) + 1] == phrase[0])
    for i in range(1, len(phrase)):
        at = at[word[at + i] == phrase[i]]
    return at


def _candidates(
    word: np.ndarray, first: np.ndarray, hits: np.ndarray, owner: np.ndarray, open_texts: np.ndarray, text: np.ndarray, idf: np.ndarray, whole: bool, rare: int,
) -> np.ndarray:
    """Beginnings on which enough of the file's rarest words of a template agree."""
    own = np.unique(text)
    mine = open_texts[owner] & np.isin(word[hits], own)
    at, of = hits[mine], owner[mine]
    if not len(at):
        return at
    # The template's words by rarity; in every file the first ones that it holds are looked up.
    by_rarity = own[np.lexsort((own, -idf[own]))]
    place = np.zeros(len(idf), dtype=np.int64)
    place[by_rarity] = np.arange(len(own))
    pairs = np.unique(of * len(own) + place[word[at]])
    files = pairs // len(own)
    nth = np.arange(len(pairs)) - np.searchsorted(files, files)
    taken = pairs if whole else pairs[nth < rare]
    looked_up = np.isin(of * len(own) + place[word[at]], taken)
    at, of = at[looked_up], of[looked_up]
    begins = []
    for q in range(len(text)):  # the postings of a word: all its places in the template
        begins.append(at[word[at] == text[q]] - q)
        owners = of[word[at] == text[q]]
        # Inside the file a phrase must lie whole; of a notice the ends may be missing.
        inside = (begins[-1] >= first[owners]) & (begins[-1] + len(text) <= first[owners + 1]) if whole else begins[-1] >= first[owners] - len(text)
        begins[-1] = (begins[-1][inside] + len(text)) * (len(first) + 1) + owners[inside]
    keys, agree = np.unique(np.concatenate(begins), return_counts=True)
    if whole:
        return keys[agree == len(text)] // (len(first) + 1) - len(text)
    # Postings that the words looked up in this file have in the template.
    per_file = np.zeros(len(first), dtype=np.int64)
    times = np.bincount(place[text], minlength=len(own))
    np.add.at(per_file, taken // len(own), times[taken % len(own)])
    enough = keys[2 * agree >= per_file[keys % (len(first) + 1)]]
    return enough


def _scan_group(ix: Index, templates: Sequence[Template], idf: np.ndarray, first: np.ndarray, word: np.ndarray, rare: int, slack: int):
    """Template, text, beginning (within the text), end and score of every place in a group of texts."""
    hits = np.flatnonzero(word >= 0)
    owner = _owners(first, hits)
    n_texts, size = len(first) - 1, len(ix.vocabulary)
    holds = np.unique(owner * size + word[hits])
    out = []
    for t, (template, text) in enumerate(zip(templates, ix.texts)):
        needed = np.unique(np.concatenate(ix.required[t]))
        there = holds[np.isin(holds % size, needed)] // size
        open_texts = np.bincount(there, minlength=n_texts) == len(needed)
        if not open_texts.any():
            continue
        found = _candidates(word, first, hits, owner, open_texts, text, idf, template.phrase, rare)
        if not len(found):
            continue
        if template.phrase:
            of = _owners(first, found)
            out.append((np.full(len(found), t), of, found - first[of], found - first[of] + len(text), np.ones(len(found))))
            continue
        begin, of = found // (len(first) + 1) - len(text), found % (len(first) + 1)
        low, high = np.maximum(begin - slack, first[of]), np.minimum(begin + len(text) + slack, first[of + 1])
        sure = np.ones(len(begin), dtype=bool)
        for phrase in ix.required[t]:
            at = _phrase_at(word, phrase)
            sure &= np.searchsorted(at, high - len(phrase), side="right") > np.searchsorted(at, low)
        begin, of = begin[sure], of[sure]
        score = np.zeros(len(begin))
        for q, number in enumerate(text):
            p = begin + q
            fits = (p >= first[of]) & (p < first[of + 1])
            score[fits] += idf[number] * (word[p[fits]] == number)
        score /= idf[text].sum()
        begin_in = np.maximum(begin, first[of])
        end_in = np.minimum(begin + len(text), first[of + 1])
        out.append((np.full(len(begin), t), of, begin_in - first[of], end_in - first[of], score))
    if not out:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + (np.zeros(0),)
    columns = [np.concatenate(c) for c in zip(*out)]
    order = np.lexsort((columns[0], columns[2], columns[1]))
    return tuple(c[order] for c in columns)


def scan(documents: DataFrame, templates: Sequence[Template] = TEMPLATES, text: str = "text", rare: int = RARE, slack: int = SLACK) -> DataFrame:
    """The rows of ``documents`` with n_words and ``licenses``: label, base, start, end (words) and score of every place."""
    release_shuffles(documents.sparkSession)
    templates = tuple(templates)
    inner, restore = shield(documents, [text])
    ix = index(templates)
    idf = rarity(inner, ix, text)
    labels = pa.array([t.label for t in templates])
    base = pa.array([t.base for t in templates])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in chunks(batch.column(batch.schema.get_field_index("text"))):
                per_text, first, word = _words(ix, data, offsets)
                t, of, start, end, score = _scan_group(ix, templates, idf, first, word, rare, slack)
                ends = pa.array(np.searchsorted(of, np.arange(high - low + 1)).astype(np.int32))
                places = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(
                    [labels.take(pa.array(t)), base.take(pa.array(t)), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(score, pa.float64())],
                    names=["label", "base", "start", "end", "score"]))
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(per_text, pa.int64()), places], names=[*part.schema.names, "n_words", "licenses"])

    # The text moves to a name of the operator's own.
    rows = inner.select(*(named(c).alias("text" if c == text else c) for c in inner.columns))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    found = rows.mapInArrow(run, ", ".join([*fields, "n_words bigint, licenses array<struct<label:string,base:boolean,start:bigint,end:bigint,score:double>>"]))
    return restore(found.withColumnRenamed("text", text), "n_words", "licenses")
