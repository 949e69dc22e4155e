"""Licence scan: a positional index of rare licence words, looked up by the rarest licence words of each file.

How rare a word is comes from all files (inverse document frequency). Each key phrase is posted in the index under its
rarest word, with the place of that word and of the next rarest one. A file looks up those of its words that are in the
index, rarest first: a posting is met where the two words stand at the right distance, and the phrase must then match in
full. So a file meets the templates whose rarest word it holds, however many there are. A template's score is the share of
its wording, weighed by rarity, that stands around the phrase.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import shield

# Label, wording, and the key phrase that must be there in full.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files", "permission is hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "licensed under the gnu general public license version", "general public license"),
    ("lgpl", "licensed under the gnu lesser general public license version", "lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license version", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that",
     "redistribution and use in source and binary forms"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted", "permission to use copy modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by", "creative commons attribution 4 0 international license", "creative commons attribution 4"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0", "cc by nc sa"),
)
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")

#: Bytes of words: digits, lower-case letters and all of other scripts; A-Z become a-z, anything else a gap.
FOLD = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256))
VOCABULARY = frozenset(w.encode() for _, text, _ in TEMPLATES for w in text.split())


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if isinstance(text, str) else []


def rarity(docs: DataFrame, text_col: str = "text") -> dict[bytes, float]:
    """Inverse document frequency of each licence word over all rows; at most a number per word comes back."""
    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, n = dict.fromkeys(VOCABULARY, 0), 0
        for batch in batches:
            n += len(batch)
            for text in batch["text"]:
                for w in VOCABULARY.intersection(words_of(text)):
                    found[w] += 1
        yield pd.DataFrame({"word": ["", *(w.decode() for w in found)], "n": [n, *found.values()]})

    rows = docs.select(F.col(text_col).alias("text")).mapInPandas(counts, "word string, n bigint")
    got = {r["word"]: r["n"] for r in rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = got.get("", 0)
    return {w: math.log((total + 1) / (got.get(w.decode(), 0) + 1)) + 1 for w in VOCABULARY}


class TemplateIndex:
    """Key phrases by their rarest word, and the templates of each."""

    def __init__(self, idf: dict[bytes, float]) -> None:
        self.idf = idf
        keys = {key: [w.encode() for w in key.split()] for key in [*BASE, *(key for _, _, key in TEMPLATES)]}
        self.templates: dict[str, list[tuple[str, list[bytes], int]]] = {}  # label, wording, place of the phrase in it
        for label, wording, key in TEMPLATES:
            template, phrase = [w.encode() for w in wording.split()], keys[key]
            shift = next(i for i in range(len(template)) if template[i:i + len(phrase)] == phrase)
            self.templates.setdefault(key, []).append((label, template, shift))
        self.postings: dict[bytes, list[tuple[str, list[bytes], int, int]]] = {}
        for key, phrase in keys.items():
            first, second = (sorted(range(len(phrase)), key=lambda i: (-idf[phrase[i]], i)) * 2)[:2]
            self.postings.setdefault(phrase[first], []).append((key, phrase, first, second))

    def phrases(self, words: list[bytes]) -> dict[str, list[int]]:
        """Where each key phrase stands among the words of a file."""
        at: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in VOCABULARY:
                at.setdefault(w, []).append(i)
        found = {}
        for word in sorted(self.postings.keys() & at.keys(), key=lambda w: (-self.idf[w], w)):
            for key, phrase, first, second in self.postings[word]:
                starts = {p - first for p in at[word]}.intersection([p - second for p in at.get(phrase[second], ())])
                starts = sorted(s for s in starts if s >= 0 and words[s:s + len(phrase)] == phrase)
                if starts:
                    found[key] = starts
        return found

    def scan(self, text: str | None, enough: float = 0.5) -> tuple:
        """``ADDED`` for one text."""
        words = words_of(text)
        found = self.phrases(words)
        places = [s for p in BASE for s in found.get(p, ())]
        own = {label for p, label in BASE.items() if p in found}
        labels, score = set(own), 1.0 if own else 0.0
        for key, starts in found.items():
            for label, template, shift in self.templates.get(key, ()):
                weight = sum(self.idf[w] for w in template)
                for start in starts:
                    there = sum(self.idf[w] for i, w in enumerate(template, start - shift) if 0 <= i < len(words) and words[i] == w) / weight
                    if there >= enough:
                        labels.add(label)
                        score = max(score, min(1.0, there))
        return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(own)),
                ",".join(sorted(labels)), score)


def scan_column(text: Column, idf: dict[bytes, float], enough: float = 0.5) -> Column:
    index = TemplateIndex(idf)

    @F.pandas_udf("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,labels:string,score:double>")
    def scan(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([index.scan(t, enough) for t in texts], columns=list(ADDED))
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    return scan(text)


def scan_licenses(docs: DataFrame, text_col: str = "text", enough: float = 0.5) -> DataFrame:
    """Input rows with ``ADDED``; columns of these names are replaced.

    A template's label counts if its key phrase matches in full and ``enough`` of its weighed wording stands around it;
    the labels of base phrases always count. Null and empty texts have no words, no labels and score 0. Rows are
    judged one by one, so repeated rows agree; an empty table stays empty.
    """
    idf = rarity(docs, text_col)
    found = scan_column(F.col(text_col), idf, enough)
    docs, back = shield(docs, [text_col], ADDED)
    return back(docs.withColumn("_found", found).select("*", "_found.*").drop("_found"))
