from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stormgrid.llm.packing import Packer, PieceIds, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def test_ids_are_the_library_s():
    texts = ["", " a", "it's  ok\n\nyes", "é 漢字 12", "<|endoftext|>x", "a b", "tab\tword", "  two  ", "'ll we'll"]
    found = PieceIds(PATH, memo_pieces=4)
    for some in (texts, texts[:1], [], texts[1:] * 2):
        for text, ids in zip(some, found.ids(some)):
            assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("sizes", [[], [1], [2048], [4096 + 300], [5000, 1, 1, 900, 2047, 300], [7] * 3000])
def test_pieces_cover_documents_without_padding(sizes):
    packer = Packer(step_tokens=8192)
    for doc, size in enumerate(sizes):
        packer.add(doc, size)
    packer.end()
    documents, sequences, groups = defaultdict(list), defaultdict(list), defaultdict(int)
    for doc, start, length, sequence, offset, tier, group in packer.placed:
        documents[doc].append((start, length))
        sequences[sequence].append((offset, length, tier))
        groups[group] += length
    for doc, size in enumerate(sizes):
        at = 0
        for start, length in sorted(documents[doc]):
            assert start == at and length > 0
            at += length
        assert at == size
    for pieces in sequences.values():
        at = 0
        for offset, length, tier in sorted(pieces):
            assert offset == at
            at += length
        assert at == tier and tier & (tier - 1) == 0 and tier <= 2048
    assert all(n <= 8192 for n in groups.values())


def packed(sizes, **more):
    packer = Packer(**more)
    for doc, size in enumerate(sizes):
        packer.add(doc, size)
    packer.end()
    pieces, groups, tiers = defaultdict(int), defaultdict(int), defaultdict(int)
    for doc, start, length, sequence, offset, tier, group in packer.placed:
        pieces[doc] += 1
        groups[group] += length
        tiers[tier] += length
    return pieces, groups, tiers


def test_few_documents_are_cut_and_groups_are_even():
    rng = np.random.default_rng(1)
    sizes = np.maximum(1, rng.lognormal(5.5, 1.2, 12_000)).astype(int).tolist()
    pieces, groups, tiers = packed(sizes)
    fit = [n for n, size in enumerate(sizes) if size <= 2048]
    assert sum(pieces[n] > 1 for n in fit) / len(fit) < 0.1
    assert sum(groups.values()) == sum(sizes) and min(groups.values()) >= 0.95 * max(groups.values())
    assert set(tiers) >= {256, 512, 1024, 2048}
    assert sum(n for t, n in tiers.items() if t < 256) < 2048


@pytest.mark.parametrize("sizes", [[1] * 70_000, [1] * 30_000 + [2048] * 300, [2047] * 500, [1025] * 700])
def test_hot_lengths_stay_bounded(sizes, monkeypatch):
    """A third of the documents may be empty, or of one length that leaves a gap."""
    from stormgrid.llm import packing

    seen = []
    old = packing.Stock.put
    monkeypatch.setattr(packing.Stock, "put", lambda self, *a: (old(self, *a), seen.append((self.items, self.tokens)))[0])
    pieces, groups, _ = packed(sizes)
    assert max(i for i, _ in seen) <= packing.STOCK_ITEMS + 1 and max(t for _, t in seen) <= packing.STOCK_TOKENS + 2048
    assert sum(groups.values()) == sum(sizes) and all(n <= 1 << 16 for n in groups.values())


def test_groups_over_several_partitions(spark):
    """Numbers of sequences and groups are apart, windows full, groups of a task even."""
    rng = np.random.default_rng(2)
    docs = spark.createDataFrame([(i, "word " * int(n)) for i, n in enumerate(rng.integers(1, 900, 900))], "doc_id long, text string")
    groups, windows, of = defaultdict(int), defaultdict(int), defaultdict(set)
    for r in pack(docs.repartition(3), PATH, step_tokens=8192).collect():
        groups[r["step_group"]] += r["length"]
        windows[r["sequence_id"], r["tier"]] += r["length"]
        of[r["sequence_id"]].add(r["step_group"])
    assert all(n == tier for (_, tier), n in windows.items()) and all(len(g) == 1 for g in of.values())
    tasks = defaultdict(list)
    for group, n in groups.items():
        tasks[group >> 36].append(n)
    assert len(tasks) == 3 and all(max(t) <= 8192 and max(t) - min(t) <= 2048 for t in tasks.values())


def test_table(awkward):
    found = defaultdict(list)
    sequences = defaultdict(int)
    for r in pack(awkward, PATH).collect():
        found[r["id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids"]))
        sequences[r["sequence_id"]] += r["length"]
    assert all(n & (n - 1) == 0 for n in sequences.values())
    wanted = defaultdict(list)
    for r in awkward.collect():
        ids = [*LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        wanted[r["doc_id"], len(ids)].append(ids)
    assert set(found) == set(wanted)
    for key, documents in wanted.items():
        pieces = sorted(found[key])
        assert sum(p[1] for p in pieces) == sum(map(len, documents))
        if len(documents) == 1:
            joined = np.frombuffer(b"".join(p[2] for p in pieces), "<u4").tolist()
            assert joined == documents[0]


def test_empty_table(nothing):
    assert pack(nothing, PATH).count() == 0


def test_tiers_are_powers_of_two(nothing):
    with pytest.raises(ValueError):
        pack(nothing, PATH, tiers=(300,))
