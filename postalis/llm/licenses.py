"""Licence scans by a positional rare-token index.

Templates are short licence texts. Document frequencies of their words are counted over all documents; of each template
that a file can hold, the rarest words are looked up in the template's postings, each hit votes with the word's weight
for the place where the template would start, and a start whose votes can reach the least score together with all the
other words is checked word by word and for the template's mandatory phrase. No start that reaches the least score
is left out. Beside that, base labels come from fixed phrases.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalis.llm.common import map_arrow, raw

# Phrases that label a place by themselves.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Fixed values: (label, template text, mandatory phrase), from the public licences' own wording and usual notices.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    ("mit", "released under the mit license", "the mit license"),
    ("mit", "licensed under the mit license", "the mit license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "the apache license version 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("cc-by", "licensed under cc by 4 0", "under cc by 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "under cc by sa 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "under cc by nd 4 0"),
    ("cc0", "to the extent possible under law the author has dedicated all copyright and related rights to this work to the public domain", "to the public domain"),
    ("proprietary", "all rights reserved", "all rights reserved"),
]
#: ASCII letters and digits and all bytes of other characters are parts of words; the rest separates.
SEPARATED = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of the text, A-Z in lower case. (DEL counts as a separator, as in the class's bounds.)"""
    return (text or b"").lower().translate(SEPARATED).split()


class Index:
    def __init__(self, frequency: dict[bytes, int], n_docs: int) -> None:
        self.labels = [t[0] for t in TEMPLATES]
        self.words = [t[1].encode().split() for t in TEMPLATES]
        self.must = [t[2].encode().split() for t in TEMPLATES]
        idf = {w: math.log((1 + n_docs) / (1 + frequency.get(w, 0))) for words in self.words for w in words}
        self.weights = [{w: idf[w] + 1e-9 for w in words} for words in self.words]
        self.total = [sum(weight[w] for w in words) for words, weight in zip(self.words, self.weights, strict=True)]
        self.rare = [sorted(weight, key=lambda w: (-weight[w], w)) for weight in self.weights]
        self.postings: list[dict[bytes, list[int]]] = []
        for words in self.words:
            self.postings.append({w: [at for at, x in enumerate(words) if x == w] for w in words})
        self.needs = [frozenset(must) for must in self.must]
        self.phrases = [(p.encode().split(), label) for p, label in PHRASES.items()]

    def near(self, t: int, least: float) -> float:
        """Weight that the least score needs, less what rounding of sums may take."""
        return least * self.total[t] * (1 - 1e-9)

    def base(self, words: list[bytes], distinct: set[bytes]) -> list[tuple[int, str]]:
        found = []
        for phrase, label in self.phrases:
            if distinct.issuperset(phrase):
                found += [(at, label) for at, w in enumerate(words) if w == phrase[0] and words[at : at + len(phrase)] == phrase]
        return found

    def matches(self, words: list[bytes], distinct: set[bytes], rarest: int, least: float) -> dict[str, float]:
        """label -> share of a template's weight that stands in place, of its best verified start, where `least` or more.

        A template whose mandatory phrase has a word that the file lacks can't be verified, so its postings are skipped.
        """
        able = [t for t, need in enumerate(self.needs) if need <= distinct]
        places: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        rest: dict[int, float] = {}  # weight of a template's words in the file that don't vote
        for t in able:
            rest[t] = sum(self.weights[t][w] for w in self.words[t] if w in distinct)
            for nth, w in enumerate(self.rare[t]):
                if nth >= rarest and rest[t] < self.near(t, least):  # without a vote a start can't reach the least score
                    break
                if w in distinct:
                    rest[t] -= self.weights[t][w] * len(self.postings[t][w])
                    places[w] += [(t, at) for at in self.postings[t][w]]
        starts: Counter = Counter()
        for at, w in enumerate(words):
            for t, place in places.get(w, ()):
                starts[t, at - place] += self.weights[t][w]
        out: dict[str, float] = {}
        for (t, start), voted in starts.items():
            if voted + rest[t] < self.near(t, least):
                continue
            template, must, weight = self.words[t], self.must[t], self.weights[t]
            have = sum(weight[w] for k, w in enumerate(template) if 0 <= start + k < len(words) and words[start + k] == w)
            low, high = max(0, start), start + len(template)
            if (share := have / self.total[t]) >= least and any(words[k : k + len(must)] == must for k in range(low, high - len(must) + 1)):
                out[self.labels[t]] = max(out.get(self.labels[t], 0.0), share)
        return out


def frequencies(docs: DataFrame) -> tuple[dict[bytes, int], int]:
    """Documents that hold each template word, over all documents; as many rows as the templates have words."""
    vocabulary = frozenset(w for _, text, _ in TEMPLATES for w in text.encode().split())

    def make():
        def step(batch: pa.RecordBatch):
            seen: Counter = Counter()
            for text in raw(batch.column(0)):
                seen.update(vocabulary.intersection(words_of(text)))
            seen[b""] += batch.num_rows
            yield {"word": [w.decode() for w in seen], "n": list(seen.values())}

        return step

    found = map_arrow(docs.select(F.col("text").cast("string")), make, "word string, n long").groupBy("word").agg(F.sum("n")).collect()
    counts = {r[0].encode(): r[1] for r in found}
    return counts, counts.pop(b"", 0)


def scan(docs: DataFrame, rarest: int = 16, least: float = 0.6) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    docs needs doc_id and text; other columns, whatever their names, are left aside. Null and empty texts have no words,
    no labels ('') and score 0; first_word and last_word are null without a base place; very long texts are scanned
    whole. Score: the best share of a template's weight found in place, or 1 with a base phrase; templates or starts
    that tie give the same label and score. Repeated rows repeat their result; an empty table gives an empty one.
    """
    index = docs.sparkSession.sparkContext.broadcast(Index(*frequencies(docs)))  # the size of the templates

    def make():
        known = index.value

        def step(batch: pa.RecordBatch):
            found = []
            for text in raw(batch.column(1)):
                words = words_of(text)
                distinct = set(words)
                base = known.base(words, distinct)
                own = known.matches(words, distinct, rarest, least)
                fixed = sorted({label for _, label in base})
                places = [at for at, _ in base]
                found.append((len(words), len(base), min(places, default=None), max(places, default=None), ",".join(fixed), ",".join(sorted({*fixed, *own})), 1.0 if base else min(1.0, max(own.values(), default=0.0))))
            names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
            yield dict(zip(names, zip(*found, strict=True) if found else [[]] * 7, strict=True)) | {"doc_id": batch.column(0)}

        return step

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
