"""Viterbi against all segmentations, and exact round trips."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from monthwise.llm import sentencepieces as sp

M = sp.MARK


@pytest.fixture(scope="module")
def codec():
    return sp.Codec(sp.read_model())


def small_codec():
    rng = random.Random(3)
    pieces = ["<unk>"] + [f"<0x{b:02X}>" for b in range(256)]
    byte_ids = list(range(1, 257))
    for p in [M, "a", "b", "c", M + "a", "ab", "bc", "abc", M + "ab", "ca", M + M, "bca"]:
        pieces.append(p)
    scores = [0.0] * 257 + [-rng.random() * 5 - 0.1 for _ in pieces[257:]]
    trie = sp.Trie.build({p: i for i, p in enumerate(pieces) if i >= 257})
    return sp.Codec((trie.packed(), scores, pieces, byte_ids))


def best_score(codec, s):
    """Largest total over all segmentations of the marked text, by recursion on prefixes."""
    normal = {p: codec.scores[i] for i, p in enumerate(codec.pieces) if i >= 257}
    best = [0.0] + [-1e18] * len(s)
    for j in range(1, len(s) + 1):
        for i in range(j):
            if s[i:j] in normal:
                best[j] = max(best[j], best[i] + normal[s[i:j]])
        if s[j - 1] not in normal:
            best[j] = max(best[j], best[j - 1] + codec.unknown)
    return best[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc é日\n", max_size=14))
def test_viterbi_is_optimal(text):
    c = small_codec()
    ids = np.frombuffer(c.encode(text), "<i4").tolist()
    if not text:
        assert ids == []
        return
    total, run = 0.0, 0
    for i in ids:
        total += c.scores[i] if i >= 257 else 0
    unknown = sum(ch not in "abc " for ch in text)
    assert abs(total + unknown * c.unknown - best_score(c, M + text.replace(" ", M))) < 1e-6
    assert c.decode(ids) == text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=f"ab {M}\0\n<0x1>é", max_size=40))
def test_round_trip(text):
    c = _shared()
    assert c.decode(np.frombuffer(c.encode(text), "<i4").tolist()) == text


def _shared(box=[]):  # noqa: B006
    if not box:
        box.append(sp.Codec(sp.read_model()))
    return box[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=f"abc é日\n{M}\0", max_size=40), max_size=12))
def test_solving_together_equals_one_by_one(texts):
    for c in (small_codec(), _shared()):
        c.cache.clear()
        got = c.round_trips([*texts, None])
        assert got.pop() is None
        for t, (ids, n_bytes, back) in zip(texts, got):
            want = [i for s in c.split(t) for i in ([c.byte_ids[0]] if s == sp.NUL else c.best(s))]
            assert np.frombuffer(ids, "<i4").tolist() == want
            assert n_bytes == sum(i in c.byte_ids for i in want) and back == c.decode(want) == t


def test_codecs_are_kept_by_their_whole_model():
    (trie, scores, pieces, byte_ids) = sp.read_model()
    other = (trie, [scores[0] - 1, *scores[1:]], pieces, byte_ids)
    assert sp._digest((trie, scores, pieces, byte_ids)) != sp._digest(other)
    assert sp._codec(sp._digest(other), other) is not sp._codec(sp._digest((trie, scores, pieces, byte_ids)), (trie, scores, pieces, byte_ids))


def test_double_array_holds_exactly_the_pieces(codec):
    t = codec.trie
    found = 0
    for i, p in list(enumerate(codec.pieces))[::37]:
        at = 0
        for ch in p:
            to = t.base[at] + t.chars.get(ch, -10**9)
            if to < 0 or to >= len(t.check) or t.check[to] != at:
                at = -1
                break
            at = to
        if at > 0 and t.value[at] == i:
            found += 1
    assert found > 800


def test_known_pieces(codec):
    assert [codec.pieces[i] for i in np.frombuffer(codec.encode("日 \U0001F9FF"), "<i4")][-4:] == ["<0xF0>", "<0x9F>", "<0xA7>", "<0xBF>"]


def test_frames_and_edges(spark):
    texts = [None, "", " ", "hello world", "a" * 50_000, "x\0y", f"raw {M} mark"]
    df = spark.createDataFrame([(i, t, "i", "x") for i, t in enumerate(texts)] + [(3, "hello world", "i", "x"), (None, "q", "", "")],
                               "doc_id long, text string, ids string, id string")
    enc = sp.encode(df)
    back = sp.decode(enc).collect()
    assert len(back) == 9
    assert all(r["text"] == (texts[r["doc_id"]] if r["doc_id"] is not None else "q") for r in back)
    assert sp.encode(df.limit(0)).count() == 0
