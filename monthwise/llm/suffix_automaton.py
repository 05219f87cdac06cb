"""Suffix automata of word sequences: building, shipping and matching statistics.

An automaton is built over one sequence of word numbers, in which the texts of a shard are
divided by numbers of their own.  A state knows the smallest document among the
occurrences of its strings.  It is shipped as arrays: the state made for a position has an
edge to the next position's state by the next word, so only the other edges are listed.
"""

from __future__ import annotations

import io
import zlib

import numpy as np

NOWHERE = np.iinfo(np.int64).max


def build(texts: list[np.ndarray], docs: list[int]) -> bytes:
    """The packed automaton of ``texts`` (64-bit words); ``docs`` are their documents."""
    vocabulary, numbers = np.unique(np.concatenate(texts), return_inverse=True)
    ends = np.cumsum([len(t) for t in texts])[:-1]
    sequence, of = [], []
    for k, part in enumerate(np.split(numbers, ends)):
        sequence += [*part.tolist(), -1 - k]
        of += [docs[k]] * (len(part) + 1)
    edges, link, length, first = _states(sequence, of)
    main = _main_states(edges, sequence)
    return _packed(vocabulary, edges, link, length, first, main, sequence)


def _states(sequence: list[int], of: list[int]):
    """Online construction: per state its edges, suffix link, longest length and document."""
    edges: list[dict[int, int]] = [{}]
    link, length, first = [-1], [0], [NOWHERE]
    last = 0
    for word, doc in zip(sequence, of):
        state = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        first.append(doc)
        link.append(0)
        p = last
        while p != -1 and word not in edges[p]:
            edges[p][word] = state
            p = link[p]
        if p != -1:
            q = edges[p][word]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(edges)
                edges.append(edges[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                first.append(NOWHERE)
                while p != -1 and edges[p].get(word) == q:
                    edges[p][word] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    for state in np.argsort(np.array(length), kind="stable")[::-1].tolist():      # long strings first
        up = link[state]
        if up >= 0 and first[state] < first[up]:
            first[up] = first[state]
    return edges, link, length, first


def _main_states(edges: list[dict[int, int]], sequence: list[int]) -> np.ndarray:
    """The states of the whole prefixes, in the order of positions."""
    out, state = np.zeros(len(sequence) + 1, dtype=np.int32), 0
    for i, word in enumerate(sequence):
        state = edges[state][word]
        out[i + 1] = state
    return out


def _packed(vocabulary, edges, link, length, first, main, sequence) -> bytes:
    nxt = dict(zip(main[:-1].tolist(), zip(sequence, main[1:].tolist())))
    source, word, target = [], [], []
    for state, own in enumerate(edges):
        usual = nxt.get(state)
        for w, to in own.items():
            if w >= 0 and usual != (w, to):
                source.append(state)
                word.append(w)
                target.append(to)
    out = io.BytesIO()
    np.savez(out, vocabulary=vocabulary, link=np.array(link, np.int32), length=np.array(length, np.int32),
             first=np.array(first, np.int64), main=main, sequence=np.array(sequence, np.int32),
             source=np.array(source, np.int32), word=np.array(word, np.int32), target=np.array(target, np.int32))
    return zlib.compress(out.getvalue(), 1)


class Matcher:
    """Matching statistics of texts against a packed automaton."""

    def __init__(self, blob: bytes):
        with np.load(io.BytesIO(zlib.decompress(blob))) as a:
            self.vocabulary = a["vocabulary"]
            self.link, self.length, self.first = (a[x].tolist() for x in ("link", "length", "first"))
            n = len(self.vocabulary)
            state, word = a["main"][:-1].astype(np.int64), a["sequence"].astype(np.int64)
            real = word >= 0
            keys = np.concatenate((state[real] * n + word[real], a["source"].astype(np.int64) * n + a["word"]))
            self.edges = dict(zip(keys.tolist(), np.concatenate((a["main"][1:][real], a["target"])).tolist()))

    def found(self, text: np.ndarray, doc: int, window: int) -> np.ndarray:
        """Per position whether the ``window`` words that end there occur in a document before ``doc``."""
        n, at = len(self.vocabulary), np.searchsorted(self.vocabulary, text)
        at[at == n] = 0
        known = self.vocabulary[at] == text
        edges, link, length, first = self.edges, self.link, self.length, self.first
        out = np.zeros(len(text), dtype=bool)
        state = matched = 0
        for i, (word, ok) in enumerate(zip(at.tolist(), known.tolist())):
            if not ok:
                state = matched = 0
                continue
            to = edges.get(state * n + word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = edges.get(state * n + word)
            if to is None:
                matched = 0
                continue
            state = to
            matched += 1
            if matched >= window:
                while length[link[state]] >= window:      # the state that holds the last ``window`` words
                    state = link[state]
                matched = window
                out[i] = first[state] < doc
        return out
