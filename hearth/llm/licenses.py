"""Licence scans with a positional index of rare words.

The licence notices (``NOTICES``) and base phrases (``PHRASES``) are indexed by
word and position.  How rare a licence word is, is counted over all texts.  A
text's rarest licence words are looked up; each occurrence votes for where the
notice would begin (its own position less the word's position in the notice),
votes within ``DRIFT`` words are added, and the best beginning is verified: the
notice's mandatory phrases must stand there.  Its score is the share of the
notice's words found at their places.  ``RAREST`` bounds only who votes: what a
notice must hold is checked in the text itself.  Base phrases are found through their
rarest word, and every place counts.

Defined results: a null or empty text has no words, no places, no labels and
score 0; repeated rows repeat their result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm import _common as C

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Label, opening of the public notice, mandatory phrases (all of them).
NOTICES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files", ["permission is hereby granted free of charge", "associated documentation files"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ["general public license version 2"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["general public license version 3"]),
    ("gpl-2.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                "license as published by the free software foundation either version 2 of the license or at your option any later version",
     ["gnu general public license as published by the free software foundation", "version 2 of the license"]),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                "license as published by the free software foundation either version 3 of the license or at your option any later version",
     ["gnu general public license as published by the free software foundation", "version 3 of the license"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license", ["affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ["redistribution and use in source and binary forms"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-nd", "licensed under cc by nd 4 0", ["cc by nd 4 0"]),
    ("cc0", "released under cc0 1 0 universal public domain dedication", ["cc0 1 0"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["for any purpose with or without fee is hereby granted"]),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
     ["eclipse public license"]),
]

RAREST, DRIFT, SHARE = 12, 2, 0.6
_WORDS = bytes(32 if c < 48 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 127 else c + 32 if 65 <= c <= 90 else c
               for c in range(256))


def words(text: str) -> list[bytes]:
    """ASCII-lower-cased runs of ASCII letters, digits and anything beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split()


class Index:
    """Notices and phrases by word; ``idf`` by word."""

    def __init__(self, documents: int, counts: dict[bytes, int]):
        self.notices = [(label, text.encode().split(), [p.encode().split() for p in keys]) for label, text, keys in NOTICES]
        self.phrases = [(p.encode().split(), label) for p, label in PHRASES.items()]
        self.idf = {w: math.log((1 + documents) / (1 + counts.get(w, 0))) for w in vocabulary()}
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for t, (_, text, _) in enumerate(self.notices):
            for i, w in enumerate(text):
                self.postings.setdefault(w, []).append((t, i))
        self.needs = [frozenset(w for key in keys for w in key) for _, _, keys in self.notices]
        # a phrase is looked up by its rarest word
        self.probe = [max(range(len(p)), key=lambda i: (self.idf[p[i]], -i)) for p, _ in self.phrases]
        self.known = frozenset(self.idf)

    def scan(self, text: str):
        ws = words(text)
        present = self.known.intersection(ws)
        possible = [t for t, need in enumerate(self.needs) if need <= present]
        phrases = [k for k, (p, _) in enumerate(self.phrases) if present.issuperset(p)]
        if not possible and not phrases:
            return len(ws), 0, None, None, "", "", 0.0
        at: dict[bytes, list[int]] = {}
        for i, w in enumerate(ws):
            if w in present:
                at.setdefault(w, []).append(i)
        places, base = [], set()
        for k in phrases:
            phrase, label = self.phrases[k]
            probe = self.probe[k]
            found = [i - probe for i in at[phrase[probe]] if i >= probe and ws[i - probe:i - probe + len(phrase)] == phrase]
            if found:
                places += found
                base.add(label)
        labels, best = set(base), 0.0
        for t in possible:
            score = self._notice(t, ws, at)
            if score >= SHARE:
                labels.add(self.notices[t][0])
                best = max(best, score)
        if base:
            best = max(best, SHARE)
        return (len(ws), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), best)

    def _notice(self, t: int, ws: list[bytes], at: dict[bytes, list[int]]) -> float:
        """The best share of notice ``t``'s words at their places, 0 where its mandatory phrases are missing."""
        _, text, keys = self.notices[t]
        rarest = sorted({w for w in text if w in at}, key=lambda w: (-self.idf[w], w))[:RAREST]
        votes: dict[int, int] = {}
        for w in rarest:
            for notice, i in self.postings[w]:
                if notice == t:
                    for p in at[w]:
                        votes[p - i] = votes.get(p - i, 0) + 1
        best = 0.0
        for begin, n in sorted(votes.items(), key=lambda x: (-x[1], x[0])):
            near = sum(votes.get(begin + d, 0) for d in range(-DRIFT, DRIFT + 1))
            if near < min(len(rarest), 2):
                break
            lo, hi = max(0, begin - DRIFT), begin + len(text) + DRIFT
            part = ws[lo:hi]
            if all(any(part[i:i + len(key)] == key for i in range(len(part))) for key in keys):
                hit = sum(any(0 <= begin + i + d < len(ws) and ws[begin + i + d] == w for d in range(-DRIFT, DRIFT + 1))
                          for i, w in enumerate(text))
                best = max(best, hit / len(text))
                if best == 1.0:
                    break
        return best


def vocabulary() -> set[bytes]:
    """Every word of a notice or phrase (a fixed, small set)."""
    return {w for text in [*PHRASES, *(x for _, t, keys in NOTICES for x in (t, *keys))] for w in text.encode().split()}


def fit(docs: DataFrame, text_col: str = "text") -> Index:
    """Count in how many texts each licence word occurs; the driver gets one number a word."""
    known = frozenset(vocabulary())
    found = C.map_text(docs, lambda texts: [[sorted(known.intersection(words(t))) for t in texts]],
                       T.StructType([T.StructField("__words", T.ArrayType(T.BinaryType()))]), text_col, keep=[])
    counts = found.select(F.explode("__words").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    return Index(docs.count(), {bytes(r["w"]): r["n"] for r in counts.collect()})


def scan(docs: DataFrame, index: Index, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append n_words, n_base, first_word, last_word, base_labels, labels, score."""
    out = T.StructType([T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")]
                       + [T.StructField(n, T.StringType()) for n in ("base_labels", "labels")]
                       + [T.StructField("score", T.DoubleType())])
    return C.map_text(docs, lambda texts: list(zip(*map(index.scan, texts))), out, text_col, keep)


def op6_licenses(spark, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents")
    return scan(docs, fit(docs), keep=["doc_id"])
