"""Licence scans with a generalised suffix automaton.

The automaton holds every run of words of a set of licence templates: whole texts of short licences, and the notices that refer to
long ones (licence_texts; a caller may give others, whole texts of any length too). A text's words are streamed through it once: at
each word it knows the longest run ending there that some template has (the matching statistics). Long runs are chained, template by
template, into covered spans: a run extends every chain that it can still reach, at each of its places in the template, and the best
chains that don't overlap are the spans. A template is labelled when enough of its words are covered in one span. The base phrases and
the tags of SPDX lines are templates too; a place of one is a word at which it is a suffix of the current match, and a tag labels the
text by itself.

A task holds the automaton (a few thousand states, fixed by the templates) and one batch of texts.

Defined cases. Null and empty texts have no words: n_base 0, no places, empty labels, score 0. Repeated rows give repeated results, also
with null ids. Very long texts are streamed word by word; only runs and chains within reach are held. Ties between chains go to the
earlier one. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect
from collections import defaultdict
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import table
from marketloom.llm.licence_texts import IDENTIFIERS, PHRASES, TEXTS

#: A matched run of fewer words is not chained.
LEAST_RUN = 4
#: Words of the text that a chain may skip between two runs.
MOST_GAP = 8
#: Covered share of a template's words that labels a text.
COVERED = 0.6
#: A span is reported from so many covered words on, or if it labels.
LEAST_SPAN = 12

_SEPARATORS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text: runs of digits, letters and code points from 0x80."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_SEPARATORS).split()


class Automaton:
    """Generalised suffix automaton over words.

    next: transitions of each state; link: suffix links; size: longest run of each state; where: for each state, template ->
    the last positions at which the state's longest run ends (but for templates that are not chained).
    """

    def __init__(self, templates: dict[str, list[bytes]], unchained: frozenset[str] = frozenset()):
        self.next, self.link, self.size = [{}], [-1], [0]
        self.templates = templates
        ends: list[dict[str, list[int]]] = [{}]
        for name, words in templates.items():
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, word)
                while len(ends) < len(self.size):
                    ends.append({})
                ends[last].setdefault(name, []).append(at)
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            for name, own in ends[state].items():
                ends[self.link[state]].setdefault(name, []).extend(own)
        self.where = [{name: sorted(set(own)) for name, own in x.items() if name not in unchained} for x in ends]

    def _state(self, size: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        """The state for the run of state's longest run and word, which target also stands for."""
        if self.size[target] == self.size[state] + 1:
            return target
        clone = self._state(self.size[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new = self._state(self.size[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, word, self.next[state][word])
        return new

    def statistics(self, words: list[bytes]):
        """(place, state, length) of each word at which some run of a template ends."""
        following, link, size = self.next, self.link, self.size
        start = following[0]
        state = length = 0
        for at, word in enumerate(words):
            if state == 0 and word not in start:
                continue
            while state and word not in following[state]:
                state = link[state]
                length = size[state]
            to = following[state].get(word)
            if to is None:
                state = length = 0
            else:
                state, length = to, length + 1
                yield at, state, length


@lru_cache(maxsize=2)
def scanner(texts: tuple[tuple[str, str], ...] = tuple(TEXTS.items())) -> tuple[Automaton, list[list[tuple[str, str, int]]]]:
    """The automaton, and for each state the phrases and tags (kind, label, words) that end every run of it of their length or more."""
    short = [("base", p, label) for p, label in PHRASES.items()] + [("tag", f"SPDX-License-Identifier: {x}", f"spdx:{x.lower()}") for x in IDENTIFIERS]
    automaton = Automaton({n: words_of(x) for n, x in texts} | {p: words_of(p) for _, p, _ in short}, frozenset(p for _, p, _ in short))
    ending: list[list[tuple[str, str, int]]] = [[] for _ in automaton.size]
    for kind, phrase, label in short:
        state = 0
        for word in words_of(phrase):
            state = automaton.next[state][word]
        ending[state].append((kind, label, len(words_of(phrase))))
    for state in sorted(range(1, len(automaton.size)), key=automaton.size.__getitem__):
        ending[state] = ending[state] + ending[automaton.link[state]]
    return automaton, ending


def chained(runs: list[tuple[int, int, dict[str, list[int]]]]) -> list[tuple[str, int, int, int]]:
    """Covered spans (template, first word, last word, covered words) of runs (last word, length, last positions by template).

    A run extends the chain with the most covered words among those of its template that end before it, at most MOST_GAP words away,
    and earlier in the template; where both overlap, words count once. Chains beyond reach are closed.
    """
    open_: dict[str, list[tuple[int, int, int, int]]] = defaultdict(list)  # first word, last word, covered, last position in the template
    done: dict[str, list[tuple[int, int, int]]] = defaultdict(list)
    for at, length, where in runs:
        for name, positions in where.items():
            near = []
            for x in open_[name]:
                if x[1] >= at - length - MOST_GAP:
                    near.append(x)
                else:
                    done[name].append(x[:3])
            new = []
            for position in positions:
                best = (length, at - length + 1)
                for first, last, covered, upto in near:
                    overlap = max(0, last - (at - length), upto - (position - length))
                    if last < at and upto < position and overlap < length and covered + length - overlap > best[0]:
                        best = (covered + length - overlap, first)
                new.append((best[1], at, best[0], position))
            open_[name] = near + new
    out = []
    for name in open_:
        taken: list[tuple[int, int]] = []  # in order
        for first, last, covered in sorted({*done[name], *(x[:3] for x in open_[name])}, key=lambda x: (-x[2], x[0], x[1])):
            k = bisect(taken, (first, last))
            if (k == 0 or taken[k - 1][1] < first) and (k == len(taken) or last < taken[k][0]):
                taken.insert(k, (first, last))
                out.append((name, first, last, covered))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def scan(text: str | None, texts: tuple[tuple[str, str], ...] = tuple(TEXTS.items())) -> dict:
    """n_words, base hits (label, first word), covered spans (template, first word, last word, covered words), labels, score."""
    automaton, ending = scanner(texts)
    words = words_of(text)
    hits: list[tuple[str, int]] = []
    tags: set[str] = set()
    runs: list[tuple[int, int, dict[str, list[int]]]] = []  # the longest run before the match shrinks
    before = None
    for at, state, length in automaton.statistics(words):
        for kind, label, n in ending[state]:
            if n <= length:
                if kind == "base":
                    hits.append((label, at - n + 1))
                else:
                    tags.add(label)
        if before and before[1] >= LEAST_RUN and (at != before[0] + 1 or length != before[1] + 1):
            runs.append((before[0], before[1], automaton.where[before[2]]))
        before = (at, length, state)
    if before and before[1] >= LEAST_RUN:
        runs.append((before[0], before[1], automaton.where[before[2]]))

    share = lambda name, covered: min(1.0, covered / len(automaton.templates[name]))
    found = chained(runs)
    spans = [x for x in found if x[3] >= LEAST_SPAN or share(x[0], x[3]) >= COVERED]
    base = {label for label, _ in hits}
    labels = base | tags | {name for name, *_, covered in spans if share(name, covered) >= COVERED}
    score = max([1.0 if hits or tags else 0.0, *(share(name, covered) for name, *_, covered in found)])
    return {"n_words": len(words), "hits": hits, "spans": spans, "base_labels": sorted(base), "labels": sorted(labels), "score": score}


SCAN = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<template:string,first_word:long,last_word:long,covered:long>>"
_SPAN = pa.list_(pa.struct([("template", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.int64())]))
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", _SPAN)])


def _scan(batches, texts):
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            x = scan(text.as_py(), texts)
            places = [at for _, at in x["hits"]]
            rows.append((doc, x["n_words"], len(places), min(places, default=None), max(places, default=None), ",".join(x["base_labels"]), ",".join(x["labels"]), x["score"], [dict(zip(("template", "first_word", "last_word", "covered"), s)) for s in x["spans"]]))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def scan_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", texts: dict[str, str] = TEXTS) -> DataFrame:
    """One row for each document: counts and places of base phrases, labels, score, and covered template spans.

    texts: licence texts by label, cut into words as documents are.
    """
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(partial(_scan, texts=tuple(texts.items())), SCAN)


def op3_license_scans(spark, sf_dir: str) -> DataFrame:
    return scan_documents(table(spark, sf_dir, "documents"))
