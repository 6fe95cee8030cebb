"""License scans: phrases, and license templates compiled to token automata.

A template is text with markup: `<<beginOptional>> ... <<endOptional>>` may be absent and
`<<var;name;least;most>>` stands for that many words of any kind; all other wording is mandatory. It compiles to a
nondeterministic automaton over words. Where the first mandatory words stand, the automaton is run on the words that
follow; it accepts if the rest of the mandatory wording follows exactly.

Words are runs of letters, digits and characters beyond ASCII, with A-Z lower-cased. Defined results: a null or
empty text has no words, no labels and score 0. Rows are scanned one by one, so repeated rows each get their own.
An empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textkernel as tk

#: Phrases that are found wherever their words stand consecutively, with their labels (fixed values).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Public license notices with markup, by label (fixed values).
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License<<beginOptional>>,<<endOptional>> Version 2.0<<beginOptional>> (the \"License\"); you may not use this file except in compliance with the License<<endOptional>>",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "<<beginOptional>>Released <<endOptional>>under the MIT License",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met<<beginOptional>>: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer<<endOptional>>",
    ],
    "isc": [
        "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "gpl-notice": [
        "This program is free software<<beginOptional>>;<<endOptional>> you can redistribute it and/or modify it under the terms of the GNU <<beginOptional>>Affero <<endOptional>><<beginOptional>>Lesser <<endOptional>>General Public License as published by the Free Software Foundation<<beginOptional>>, either version <<var;version;1;2>> of the License, or (at your option) any later version<<endOptional>>",
        "GNU General Public License<<beginOptional>> as published by the Free Software Foundation<<endOptional>> version <<var;version;1;2>>",
    ],
    "cc-by-notice": [
        "Licensed under CC BY<<beginOptional>> NC<<endOptional>><<beginOptional>> SA<<endOptional>><<beginOptional>> ND<<endOptional>> <<var;version;1;2>>",
        "licensed under a Creative Commons Attribution<<beginOptional>> NonCommercial<<endOptional>><<beginOptional>> ShareAlike<<endOptional>><<beginOptional>> NoDerivatives<<endOptional>> <<var;version;1;2>> <<beginOptional>>International <<endOptional>>License",
    ],
    "copyright-notice": ["Copyright <<beginOptional>>c <<endOptional>><<var;holder;1;8>> All rights reserved"],
}

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARKUP = re.compile(r"<<(beginOptional|endOptional|var;[^;]*;(\d+);(\d+))>>")
_ANY = np.uint64(0)


def word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(tk.run_hashes(data, np.array([0]), np.array([len(data)]), lower=True)[0])


class Automaton:
    """Steps (state, word hash or any, next state), empty steps, and the state that accepts."""

    def __init__(self, template: str) -> None:
        self.steps: list[dict[int, list[int]]] = [{}]
        self.empty: list[list[int]] = [[]]
        opened: list[int] = []
        self.lead: list[int] = []
        self.start = None
        state, at, closed = 0, 0, False
        for mark in [*_MARKUP.finditer(template), None]:
            for word in _WORD.findall(template[at : mark.start() if mark else len(template)].lower()):
                if not opened and self.start is None:
                    self.start = state
                if self.start is not None and not closed and len(self.lead) < 3:
                    self.lead.append(word_hash(word))
                state = self._step(state, word_hash(word))
            if mark is None:
                break
            at = mark.end()
            closed = self.start is not None
            if mark[1] == "beginOptional":
                opened.append(state)
            elif mark[1] == "endOptional":
                self.empty[opened.pop()].append(state)
            else:
                for _ in range(int(mark[2])):
                    state = self._step(state, int(_ANY))
                before = [state]
                for _ in range(int(mark[3]) - int(mark[2])):
                    state = self._step(state, int(_ANY))
                    before.append(state)
                for x in before[:-1]:
                    self.empty[x].append(state)
        if opened or not self.lead:
            raise ValueError("a template needs closed optional parts and a mandatory word before any variable part")
        self.accept = state

    def _step(self, state: int, word: int) -> int:
        self.steps.append({})
        self.empty.append([])
        self.steps[state].setdefault(word, []).append(len(self.steps) - 1)
        return len(self.steps) - 1

    def _closed(self, states: set[int]) -> set[int]:
        left = list(states)
        while left:
            for x in self.empty[left.pop()]:
                if x not in states:
                    states.add(x)
                    left.append(x)
        return states

    def accepts(self, words: list[int]) -> bool:
        """Whether some beginning of words leads from the start to acceptance."""
        states = self._closed({self.start})
        for word in words:
            if self.accept in states:
                return True
            states = self._closed({y for x in states for w in (word, int(_ANY)) for y in self.steps[x].get(w, ())})
            if not states:
                return False
        return self.accept in states

    @property
    def longest(self) -> int:
        return len(self.steps)


def _places(hashes: np.ndarray, row: np.ndarray, words: list[int]) -> list[int]:
    """Where these words stand consecutively in one row."""
    at = np.flatnonzero(hashes == np.uint64(words[0]))
    for k, word in enumerate(words[1:], 1):
        at = at[at + k < len(hashes)]
        at = at[(hashes[at + k] == np.uint64(word)) & (row[at + k] == row[at])]
    return at.tolist()


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of docs(doc_id, text).

    score is 1 if a template matches, 0.5 if only a phrase does, else 0.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    for texts in templates.values():
        for x in texts:
            Automaton(x)
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def scan(batches):
        wanted = [([word_hash(w) for w in _WORD.findall(k.lower())], v) for k, v in phrases.items()]
        automata = [(Automaton(x), label) for label, texts in templates.items() for x in texts]
        for batch in batches:
            rows: list[list] = [[] for _ in names[1:]]
            for _, n, data, offsets in tk.text_slices(batch.column("text")):
                hashes, row, _, _ = tk.words(data, offsets, tk.ALNUM_BYTE, lower=True)
                begin = np.searchsorted(row, np.arange(n + 1))
                base: list[list[int]] = [[] for _ in range(n)]
                base_labels: list[set[str]] = [set() for _ in range(n)]
                labels: list[set[str]] = [set() for _ in range(n)]
                for words, label in wanted:
                    for i in _places(hashes, row, words):
                        r = int(row[i])
                        base[r].append(i - int(begin[r]))
                        base_labels[r].add(label)
                for automaton, label in automata:
                    for i in _places(hashes, row, automaton.lead):
                        r = int(row[i])
                        if label not in labels[r] and automaton.accepts(hashes[i : min(int(begin[r + 1]), i + automaton.longest)].tolist()):
                            labels[r].add(label)
                for x, values in zip(
                    rows,
                    (
                        np.diff(begin).tolist(),
                        [len(x) for x in base],
                        [min(x) if x else None for x in base],
                        [max(x) if x else None for x in base],
                        [",".join(sorted(x)) for x in base_labels],
                        [",".join(sorted(x | y)) for x, y in zip(base_labels, labels, strict=True)],
                        [1.0 if y else 0.5 if x else 0.0 for x, y in zip(base, labels, strict=True)],
                    ),
                    strict=True,
                ):
                    x += values
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64())] + [pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(scan, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double")
