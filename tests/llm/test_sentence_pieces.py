import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from stormgrid.llm.pieces import Lookup
from stormgrid.llm.sentence_pieces import MARK, Chunk, Pieces, decode, encode, times, words_of, _chain

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PIECES = Pieces(PATH)


def made_up(n, seed=5):
    rng = random.Random(seed)
    alphabets = ["ab  c", "the of and  ing\n\t", "éüß漢字😀 ab", "=-* /", "abcdefghijklmnopqrstuvwxyz", "e "]
    return ["".join(rng.choice(a) for _ in range(rng.randrange(1, 120))) for a in alphabets for _ in range(n)]


def test_ids_and_texts_are_the_library_s():
    for text in [*made_up(8), "  ", "▁a ▁", "<s> </s> <0x41> <unk>", "=" * 300, "a" * 200, " " * 90]:
        ids = PIECES.encode(PIECES.lead + text.replace(" ", MARK))
        assert ids.tolist() == LIBRARY.encode(text)
        shown = PIECES.decode(ids)
        assert shown[1:] == LIBRARY.decode(ids.tolist())


def test_forgetting_words_changes_nothing(monkeypatch):
    from stormgrid.llm import sentence_pieces

    monkeypatch.setattr(sentence_pieces, "MEMO_WORDS", 4)
    small = Pieces(PATH)
    texts = made_up(4) * 3
    for at in range(0, len(texts), 3):
        some = texts[at:at + 3]
        found = small.encode_all([small.lead + t.replace(" ", MARK) for t in some])
        assert [ids.tolist() for ids in found] == [LIBRARY.encode(t) for t in some]


def test_new_words_are_chained_together(monkeypatch):
    from stormgrid.llm import sentence_pieces

    monkeypatch.setattr(sentence_pieces, "TOGETHER", 50)
    monkeypatch.setattr(sentence_pieces, "PAIRS", 100)
    texts = [*made_up(12), "ab" * 32, "ab" * 33, "x", "\U0010ffff", "e\U0010ffff\x00é", "", " " * 64, " " * 65]
    some = Pieces(PATH)
    looked_at = []
    monkeypatch.setattr(some, "at", lambda text, end: looked_at.append(text) or Pieces.at(some, text, end))
    found = some.encode_all([some.lead + t.replace(" ", MARK) if t else "" for t in texts])
    assert [ids.tolist() for ids in found] == [LIBRARY.encode(t) for t in texts]
    # One at a time only what is too long for a table of all.
    assert looked_at and all(len(t) > sentence_pieces.SHORT for t in looked_at)


def test_no_merge_goes_over_the_end_of_a_word():
    some = Pieces(PATH)
    some.encode(f"{MARK}thedoran.{MARK}thedoran,{MARK}thedoran\n")
    assert set(some.words) == {f"{MARK}thedoran", ".", ",", "\n"}


@pytest.mark.parametrize("sets", [1, 8])
def test_words_of_pieces(monkeypatch, sets):
    from stormgrid.llm import sentence_pieces

    monkeypatch.setattr(sentence_pieces, "SETS", sets)
    pieces = [MARK, MARK * 2, f"{MARK}ab", "bc", "]-", "^\\", "12", "x"]
    word = words_of(pieces)
    apart = word.findall(f"{MARK * 3}cab]-^\\21xx{MARK}{MARK}")
    rest = ["]-", "^\\", "21"] if sets == 8 else ["]-^\\21"]
    assert apart == [f"{MARK * 3}cab", *rest, "x", "x", MARK * 2]


def test_lookup():
    rng = np.random.default_rng(3)
    keys = np.unique(np.concatenate([rng.integers(-1 << 40, 1 << 60, 90_000), np.arange(-5, 60_000) << 32]))
    rng.shuffle(keys)
    held = Lookup(keys[:10], range(10))
    for at in range(10, len(keys), 40_000):
        held.add(keys[at:at + 40_000], np.arange(at, min(len(keys), at + 40_000), dtype=np.int32))
    assert (held.get(keys) == np.arange(len(keys))).all()
    assert (held.get(np.setdiff1d(keys + 1, keys)) == -1).all()
    assert len(held.get(keys[:0])) == 0


def test_bytes_that_are_no_utf8():
    ids = [PIECES.byte_ids[b] for b in b"\xe6\xbc\xff"]
    assert PIECES.decode(np.array(ids)) == "�" * 3 == LIBRARY.decode(ids)


@pytest.mark.parametrize("size", [5, 33])
def test_chunks_by_max_plus_scan(size):
    for text in made_up(3, size):
        whole = PIECES.lead + text.replace(" ", MARK)
        n, margin = -(-len(whole) // size), 2 * PIECES.longest
        chunks = []
        for k in range(n):
            low = max(0, k * size - margin)
            chunks.append(Chunk(whole[low:(k + 1) * size + margin], k * size - low, min(len(whole), (k + 1) * size) - low))
        matrices = [c.matrix(PIECES, k == 0, k == n - 1) for k, c in enumerate(chunks)]
        left = right = None
        for m in matrices:  # products are the same however they are put together
            left = m if left is None else times(left, m)
        for m in reversed(matrices):
            right = m if right is None else times(m, right)
        assert left == right == {((0, 0), (0, 0)): left[(0, 0), (0, 0)]}
        best = {(0, 0): (0, ())}
        for m in matrices:
            step = {}
            for (s, t), w in m.items():
                if s in best and (t not in step or step[t][0] < best[s][0] + w):
                    step[t] = best[s][0] + w, (best[s][1], t)
            best = step
        states = [(0, 0), *_chain(best[0, 0][1])]
        ids = [i for k, c in enumerate(chunks) for i in c.trace(PIECES, k == 0, k == n - 1, states[k], states[k + 1]).tolist()]
        assert ids == LIBRARY.encode(text)


@pytest.mark.parametrize("chunk, block", [(1 << 14, 256), (64, 4)])
def test_table(awkward, chunk, block):
    parts = encode(awkward, PATH, chunk=chunk, block=block)
    found = {}
    for r in decode(parts, PATH, keep_ids=True).collect():
        found.setdefault((r["doc_id"], r["row"]), []).append((r["part"], bytes(r["ids"]), r["text"]))
    documents = sorted(
        (i if i is not None else -1, np.frombuffer(b"".join(p[1] for p in sorted(ps)), "<i4").tolist(), "".join(p[2] for p in sorted(ps)))
        for (i, row), ps in found.items() for ps in ([ps] if row is not None else [[p] for p in ps]))
    wanted = sorted((r["doc_id"] if r["doc_id"] is not None else -1, LIBRARY.encode(r["text"] or ""), r["text"] or "") for r in awkward.collect())
    assert documents == wanted
    assert parts.filter(F.col("part") > 0).isEmpty() == (chunk == 1 << 14 and max(len(r["text"] or "") for r in awkward.collect()) < chunk)


def test_empty_table(nothing):
    assert encode(nothing, PATH).count() == 0
