"""License scans: phrases, and an exact containment join of text blocks with templates.

A text's words are cut into blocks of ``BLOCK_WORDS`` words, one starting every
``STRIDE`` words, so every template, of at most ``STRIDE`` words, stands whole in some
block.  A block matches a template when it holds at least ``CONTAINED`` of its distinct
words.  All such pairs are found by the filters of a set-similarity join: words are in
one global order, rarest first (counted over all documents; words of no template come
before all others and never match); a match must hit the template's prefix; the block
must have enough words; the place of the first common word in both bounds what can
still follow.  What passes is verified.

Defined cases: a null or empty text has no words, no labels and score 0; score is the
best containment, 1 where a phrase stands in the text.  Repeated rows are alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import texts_of

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Templates of this method: notices and sentences of well-known licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                  "GNU General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
CONTAINED = 0.8
BLOCK_WORDS, STRIDE = 64, 32
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
          "labels array<string>, score double")


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z alone) of UTF-8 bytes."""
    return WORDS.findall(text.lower())


def needed(n: int, contained: float = CONTAINED) -> int:
    return math.ceil(contained * n - 1e-9)


class Join:
    """The templates in global order, with the index of their prefixes."""

    def __init__(self, templates: dict[str, str], counts: dict[bytes, int], phrases: dict[str, str] = PHRASES):
        sets = {label: set(words_of(t.encode())) for label, t in templates.items()}
        if any(len(words_of(t.encode())) > STRIDE for t in templates.values()):
            raise ValueError(f"a template has more than {STRIDE} words")
        rarest = sorted(set().union(*sets.values()), key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: k for k, w in enumerate(rarest)}
        self.sorted = {label: sorted(s, key=self.rank.__getitem__) for label, s in sets.items()}
        self.prefix: dict[bytes, list[str]] = {}
        for label, words in self.sorted.items():
            for w in words[:len(words) - needed(len(words)) + 1]:
                self.prefix.setdefault(w, []).append(label)
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]

    def block(self, words: list[bytes]) -> dict[str, float]:
        """Containment of the templates that the block matches."""
        mine = sorted({w for w in words if w in self.rank}, key=self.rank.__getitem__)
        out = {}
        for label in {t for w in mine if w in self.prefix for t in self.prefix[w]}:
            theirs = self.sorted[label]
            n, need = len(theirs), needed(len(theirs))
            if len(mine) < need:                                           # length
                continue
            common = set(mine)
            first = next((k for k, w in enumerate(theirs) if w in common), n)
            place = mine.index(theirs[first])
            if 1 + min(n - first - 1, len(mine) - place - 1) < need:       # position
                continue
            overlap = len(common.intersection(theirs))
            if overlap >= need:
                out[label] = overlap / n
        return out

    def scan(self, text: bytes) -> dict:
        words = words_of(text)
        base: dict[str, list[int]] = {}
        for phrase, label in self.phrases:
            at, k = -1, len(phrase)
            try:
                while True:
                    at = words.index(phrase[0], at + 1)
                    if words[at:at + k] == phrase:
                        base.setdefault(label, []).append(at)
            except ValueError:
                pass
        places, found = list(chain.from_iterable(base.values())), {}
        if not self.prefix.keys().isdisjoint(words):
            hits = [i for i, w in enumerate(words) if w in self.prefix]
            for b in sorted({b for i in hits for b in (i // STRIDE, i // STRIDE - 1) if b >= 0}):
                for label, part in self.block(words[b * STRIDE:b * STRIDE + BLOCK_WORDS]).items():
                    found[label] = max(part, found.get(label, 0.0))
        return {"n_words": len(words), "n_base": len(places), "first_word": min(places, default=None),
                "last_word": max(places, default=None), "base_labels": sorted(base),
                "labels": sorted({*base, *found}), "score": 1.0 if places else max(found.values(), default=0.0)}


def word_counts(docs: DataFrame, templates: dict[str, str], text_col: str = "text") -> dict[bytes, int]:
    """How often each word of the templates occurs in all documents: one row per word."""
    vocabulary = frozenset(chain.from_iterable(words_of(t.encode()) for t in templates.values()))

    def count(batches):
        total = Counter()
        for batch in batches:
            for text in texts_of(batch.column(0)):
                total.update(filter(vocabulary.__contains__, words_of(text)))
        yield pa.record_batch([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in rows.collect()}


def scanned(text: Column, counts: dict[bytes, int], templates: dict[str, str] = TEMPLATES) -> Column:
    """Struct of what a text holds: see ``SCHEMA``."""
    kind = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                      ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64())])

    def run(texts: pa.Array) -> pa.Array:
        join = Join(templates, counts)
        return pa.array([join.scan(t) for t in texts_of(texts)], kind)

    return F.arrow_udf(run, SCHEMA)(text)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id and the columns of ``SCHEMA``."""
    counts = word_counts(docs, templates, text_col)
    return (docs.select(F.col(id_col).alias("doc_id"), scanned(F.col(text_col), counts, templates).alias("s"))
            .select("doc_id", "s.*"))
