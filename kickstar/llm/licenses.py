"""Licence scan: templates in markup, compiled into token automata.

Template markup (as in licence lists):

* ``<<optional>> ... <<end>>``: the words may be there or not; may be nested;
* ``<<var 0-20>>``: replaceable text, between 0 and 20 words of any kind;
* all else is mandatory wording: its words must stand there exactly, in order.

A template becomes an automaton over words: states with transitions on one word, on any
word, or on nothing. A text is accepted at a place if the automaton, started there, reaches
its end. The automaton is run with the set of its live states, so each start costs at most
(states x words read), and starts are tried only where a first word of some template stands.

Each document is scanned whole, in one pass, by the task that read it: no shuffle, no group,
no broadcast beyond the templates themselves (code, not data).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kickstar.llm.common import LOWER, UPPER

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans(UPPER, LOWER)
MARK = re.compile(r"<<(optional|end|var (\d+)-(\d+))>>")


@dataclass(frozen=True)
class Template:
    label: str
    markup: str


# The phrases of the contract.
BASE = (
    Template("mit", "under the mit license"),
    Template("apache-2", "apache license version 2"),
    Template("cc-by-nc", "cc by nc"),
)

# Public licence wording (grants, notices and conditions), in markup.
TEMPLATES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                    "associated documentation files <<optional>>(the \"Software\")<<end>>, to deal in the <<var 1-3>> without "
                    "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                    "sublicense, and/or sell copies of the <<var 1-3>>"),
    Template("isc", "Permission to use, copy, modify, <<optional>>and/or<<end>> <<optional>>and<<end>> distribute this software "
                    "for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
                    "permission notice appear in all copies"),
    Template("bsd-2", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                      "that the following conditions are met <<var 0-2>> Redistributions of source code must retain the above "
                      "copyright notice, this list of conditions and the following disclaimer"),
    Template("bsd-3", "Neither the name of <<optional>>the<<end>> <<var 1-12>> nor the names of its contributors may be used to "
                      "endorse or promote products derived from this software without specific prior written permission"),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 <<optional>>(the \"License\")<<end>> "
                         "<<optional>>; you may not use this file except in compliance with the License<<end>>"),
    Template("gpl", "licensed under the <<optional>>terms of the<<end>> GNU General Public License <<optional>>as published by the "
                    "Free Software Foundation; either<<end>> <<optional>>,<<end>> version <<var 1-1>>"),
    Template("lgpl", "under the terms of the GNU <<optional>>Lesser<<end>> <<optional>>Library<<end>> General Public License as "
                     "published by the Free Software Foundation"),
    Template("cc-by-nc", "licensed under <<optional>>a<<end>> <<optional>>the<<end>> Creative Commons Attribution NonCommercial "
                         "<<var 0-2>> <<optional>>International<<end>> License"),
    Template("cc-by-nc", "Licensed under CC BY-NC <<var 1-2>>"),
    Template("cc-by", "licensed under <<optional>>a<<end>> <<optional>>the<<end>> Creative Commons Attribution <<var 1-2>> "
                      "<<optional>>International<<end>> License"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("mit", "<<optional>>Released<<end>> <<optional>>Licensed<<end>> <<optional>>Distributed<<end>> under the "
                    "<<optional>>terms of the<<end>> MIT License"),
)


def split_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_LOWER))


def parts(markup: str) -> list:
    """Markup as a list of words, ('var', low, high) and nested lists (optional parts)."""
    stack, at = [[]], 0
    for m in MARK.finditer(markup):
        stack[-1] += split_words(markup[at:m.start()])
        at = m.end()
        if m[1] == "optional":
            stack.append([])
        elif m[1] == "end":
            if len(stack) == 1:
                raise ValueError("<<end>> without <<optional>>")
            inner = stack.pop()
            stack[-1].append(inner)
        else:
            if int(m[2]) > int(m[3]):
                raise ValueError(f"empty range in {m.group()}")
            stack[-1].append(("var", int(m[2]), int(m[3])))
    stack[-1] += split_words(markup[at:])
    if len(stack) > 1:
        raise ValueError("<<optional>> without <<end>>")
    return stack[0]


def mandatory_words(markup: str) -> int:
    return sum(isinstance(x, str) for x in parts(markup))


class Automaton:
    """States 0..n; ``on[s]`` maps a word to the next state, ``any_[s]`` is the next state on
    any word, ``free[s]`` are the states reached without reading."""

    def __init__(self, markup: str):
        self.on: list[dict[str, int]] = [{}]
        self.any_: list[int | None] = [None]
        self.free: list[list[int]] = [[]]
        self.end = self._build(parts(markup), 0)
        if self.end in self._closed({0}):
            raise ValueError("a template needs mandatory wording")
        self.start = self._closed({0})
        if any(self.any_[s] is not None for s in self.start):
            raise ValueError("a template begins with mandatory or optional wording")
        self.first = {w for s in self.start for w in self.on[s]}

    def _state(self) -> int:
        self.on.append({})
        self.any_.append(None)
        self.free.append([])
        return len(self.on) - 1

    def _build(self, items: Sequence, s: int) -> int:
        for x in items:
            if isinstance(x, str):
                t = self._state()
                self.on[s][x] = t
            elif isinstance(x, list):
                inner = self._state()       # a state of its own: what follows must not leave it
                self.free[s].append(inner)
                t = self._state()
                self.free[self._build(x, inner)].append(t)
                self.free[s].append(t)
            else:
                _, low, high = x
                last = self._state()
                self.free[s].append(first := self._state())
                s = first
                for k in range(high):
                    if k >= low:
                        self.free[s].append(last)
                    t = self._state()
                    self.any_[s] = t
                    s = t
                self.free[s].append(last)
                t = last
            s = t
        return s

    def _closed(self, states: set[int]) -> frozenset[int]:
        todo, out = list(states), set(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return frozenset(out)

    def match(self, words: Sequence[str], at: int) -> int | None:
        """End (exclusive) of the longest accepted run of words that begins at ``at``."""
        live, best, i, n = self.start, None, at, len(words)
        while live and i < n:
            w, step = words[i], set()
            for s in live:
                if (t := self.on[s].get(w)) is not None:
                    step.add(t)
                if (t := self.any_[s]) is not None:
                    step.add(t)
            live = self._closed(step)
            i += 1
            if self.end in live:
                best = i
        return best


def weight(mandatory: int) -> float:
    """Confidence of a template: the more mandatory words it has, the nearer to 1."""
    return mandatory / (mandatory + 4.0)


RESULT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "spans array<struct<label:string,start:long,end:long>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: Sequence[Template] = BASE,
         templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: its id and the RESULT columns.

    ``n_base`` counts the places of base phrases, ``first_word`` and ``last_word`` are their
    smallest and largest start (null without any); ``labels`` adds the labels of accepted
    templates; ``spans`` lists every accepted place (words, end exclusive); ``score`` is the
    largest :func:`weight` of what was found, else 0. A null or empty text has no words and
    empty labels. Rows with a null id and repeated rows each keep a row; other columns are
    not read. Very long texts are scanned whole; an empty table gives no rows."""
    base_runs = [(t.label, split_words(t.markup)) for t in base]
    machines = [(t.label, weight(mandatory_words(t.markup)), Automaton(t.markup)) for t in templates]
    heads: dict[str, tuple[list, list]] = {}
    for label, run in base_runs:
        heads.setdefault(run[0], ([], []))[0].append((label, run, weight(len(run))))
    for m in machines:
        for w in m[2].first:
            heads.setdefault(w, ([], []))[1].append(m)

    def one(text: str | None) -> dict:
        ws = split_words(text)
        places, base_labels, labels, spans, score = [], set(), set(), [], 0.0
        for i, w in enumerate(ws):
            if w not in heads:
                continue
            for label, run, value in heads[w][0]:
                if ws[i:i + len(run)] == run:
                    places.append(i)
                    base_labels.add(label)
                    spans.append({"label": label, "start": i, "end": i + len(run)})
                    score = max(score, value)
            for label, value, machine in heads[w][1]:
                if (end := machine.match(ws, i)) is not None:
                    labels.add(label)
                    spans.append({"label": label, "start": i, "end": end})
                    score = max(score, value)
        return {"n_words": len(ws), "n_base": len(places), "first_word": min(places, default=None),
                "last_word": max(places, default=None), "base_labels": ",".join(sorted(base_labels)),
                "labels": ",".join(sorted(base_labels | labels)), "score": score, "spans": spans}

    kinds = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                       ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                       ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[f.name] for r in rows], f.type) for f in kinds)],
                                             ["doc_id", *kinds.names])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, {RESULT}")
