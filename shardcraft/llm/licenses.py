"""License scan with a positional index over rare template words.

Templates are short published licence sentences.  The index holds, per template
word, the (template, position) postings.  Inverse document frequencies of the
template words are counted over the whole corpus; the rarest words of a template
are its anchors.  In a file, every occurrence of an anchor is looked up; file position
minus template position is an alignment, and postings are intersected by it: a
template stays a candidate where enough of its anchors agree on one
alignment.  A candidate is accepted if its mandatory phrase stands there word by
word and enough of its remaining words stand at their places.

Base phrases are templates that are all mandatory phrase with one anchor, so
each of their places is found and verified exactly.

Defined results: null and empty texts have no words, no labels and score 0;
repeated rows are judged alike; an empty table gives no rows; other input
columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes
from .decontaminate import normal_words

RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
          "labels string, score double, places array<struct<label:string,word:long,coverage:double>>")


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    phrase: tuple[int, int]          # word range of the mandatory key phrase
    base: bool = False


def template(label: str, text: str, phrase: str, base: bool = False) -> Template:
    words, key = text.encode().split(), phrase.encode().split()
    at = next(i for i in range(len(words)) if words[i:i + len(key)] == key)
    return Template(label, tuple(words), (at, at + len(key)), base)


#: The phrases with prescribed labels, then published licence sentences
#: (lower case, words only) with the phrase that must stand unchanged.
TEMPLATES = [
    template("cc-by", "cc by", "cc by", True),
    template("gpl", "general public license", "general public license", True),
    template("reserved", "all rights reserved", "all rights reserved", True),
    template("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    template("mit", "released under the mit license", "mit license"),
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    template("gnu-gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    template("gnu-lgpl", "gnu lesser general public license version", "lesser general public license"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    template("public-domain", "released into the public domain", "public domain"),
]


class PositionalIndex:
    def __init__(self, templates: list[Template], df: dict[bytes, int], anchors: int, min_coverage: float):
        self.templates, self.min_coverage = templates, min_coverage
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.needed = []
        for t, tpl in enumerate(templates):
            rare = sorted(set(tpl.words), key=lambda w: (df.get(w, 0), w))[:1 if tpl.base else anchors]
            self.needed.append(min(2, len(rare)))
            for i, w in enumerate(tpl.words):
                if w in rare:
                    self.postings[w].append((t, i))

    def find(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """Accepted (template, first word's place, coverage)."""
        keys = self.postings.keys()
        if keys.isdisjoint(words):
            return []
        agree: dict[tuple[int, int], set[bytes]] = defaultdict(set)
        for at, w in enumerate(words):
            if w in keys:
                for t, i in self.postings[w]:
                    agree[t, at - i].add(w)
        out = []
        for (t, at), seen in agree.items():
            if len(seen) < self.needed[t]:
                continue
            tpl = self.templates[t]
            s, e = tpl.phrase
            if at + s < 0 or tuple(words[at + s:at + e]) != tpl.words[s:e]:
                continue
            there = sum(0 <= at + i < len(words) and words[at + i] == w for i, w in enumerate(tpl.words))
            if there >= self.min_coverage * len(tpl.words):
                out.append((t, at, there / len(tpl.words)))
        return sorted(out)


def document_frequencies(docs: DataFrame, templates: list[Template]) -> dict[bytes, int]:
    """Documents that hold each template word; tasks add up first, and the
    templates' words bound what reaches the driver."""
    vocabulary = frozenset(w for t in templates for w in t.words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for b in batches:
            for text in text_bytes(b.column(0)):
                n.update(vocabulary.intersection(normal_words(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())],
                                         ["word", "n"])

    rows = docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in rows.collect()}


def scan_licenses(documents: DataFrame, templates: list[Template] = TEMPLATES, anchors: int = 3,
                  min_coverage: float = 0.7) -> DataFrame:
    """One row per document, see :data:`RESULT`; ``places`` lists every accepted
    place with its share of template words."""
    docs = documents.select("doc_id", "text")
    index = PositionalIndex(templates, document_frequencies(docs, templates), anchors, min_coverage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("coverage", pa.float64())]))
        kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64(), place]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"]
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                words = normal_words(text)
                found = index.find(words)
                base = [at for t, at, _ in found if templates[t].base]
                rows.append((
                    doc, len(words), len(base), min(base, default=None), max(base, default=None),
                    ",".join(sorted({templates[t].label for t, _, _ in found if templates[t].base})),
                    ",".join(sorted({templates[t].label for t, _, _ in found})),
                    max((c for _, _, c in found), default=0.0),
                    [{"label": templates[t].label, "word": at, "coverage": c} for t, at, c in found]))
            cols = list(zip(*rows)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names)

    return docs.mapInArrow(run, RESULT)
