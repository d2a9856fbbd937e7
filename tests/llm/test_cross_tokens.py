"""Alignment of two tokenizers against one that looks at whole texts and decoded bytes only."""

import hashlib
import random
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from stormgrid.llm.cross_tokens import Aligner, align, ends_of, link_scores, stretches
from stormgrid.llm.pieces import byte_alphabet

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["the", "of", "é", "😀", "漢字", "  ", " ", "\n", "\t", "x" * 9, "<|endoftext|>", "<s>", "\x00", "12,3", "it's", "​",
         "\xa0", "\xad", "ß", "ﬁ", "क्षि", "…", "!!", "<0x41>", "👩‍👩‍👧", "ǅ", "́"]


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=B)
    stand_in = byte_alphabet()
    of_a = {i: bytes(stand_in[c] for c in t) for t, i in a.get_vocab(False).items()}
    of_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(b.vocab_size())]
    return a, b, of_a, of_b


def brute(text, tools):
    """Groups of ids, from decoded bytes of the whole text; none where they differ from it."""
    a, b, of_a, of_b = tools
    if not text:
        return []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    by_a, by_b = [of_a[i] for i in ids_a], [of_b[i] for i in ids_b]
    if not b"".join(by_a) == b"".join(by_b) == (" " + text).encode():
        return []
    end_a, end_b = list(accumulate(map(len, by_a))), list(accumulate(map(len, by_b)))
    cuts = sorted(set(end_a) & set(end_b))
    return [([i for i, e in zip(ids_a, end_a) if low < e <= high], [i for i, e in zip(ids_b, end_b) if low < e <= high])
            for low, high in zip([0, *cuts], cuts)]


def shown(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def corpus(texts, tools):
    """The query's columns for all texts."""
    found = [brute(t, tools) for t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in found]
    counts = Counter(p for own in links for p in own)
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return [(
        sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(own.values()),
        hashlib.sha256(shown(g).encode()).hexdigest() if g else "",
        sum(n for p, n in own.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in own.items()),
    ) for g, own in zip(found, links)]


def rows(spark, texts, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = link_scores(align(docs, A, B, **more), 32000).orderBy("id").collect()
    return [tuple(r)[1:] for r in got]


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(tools, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(PARTS) + rng.choice(["", " ", " "]) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    texts += ["", " ", "  ", "\n", " a", "a ", "a ▁b", "▁"]
    aligner = Aligner(A, B)
    assert aligner.apart
    for text, found in zip(texts, aligner.texts(texts)):
        want = brute(text, tools)
        links = Counter(x * 32000 + y for a, b in want for x in a for y in b)
        assert found[0] == shown(want) and dict(zip(found[2].tolist(), found[3].tolist())) == links
        assert found[1].tolist() == [sum(len(a) for a, _ in want), sum(len(b) for _, b in want), len(want), sum(links.values())]


def test_forgetting_changes_nothing(tools):
    texts = [f"word{i} and é{i} \n more" for i in range(50)]
    small = Aligner(A, B, memo=3)
    got = [found[0] for at in range(0, 50, 5) for found in small.texts(texts[at:at + 5])]
    assert got == [shown(brute(t, tools)) for t in texts]


def test_counts_over_the_corpus(spark, awkward, tools):
    texts = [r["text"] for r in awkward.collect()]
    assert rows(spark, texts) == corpus([t or "" for t in texts], tools)


def test_shuffled_and_broadcast_pairs_agree(spark, tools):
    texts = [f"the cat {i} sat on é {i % 7}" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = align(docs, A, B)
    want = corpus(texts, tools)
    for hot in (1, 30, 10 ** 6):  # nearly all pairs shuffled, some, none
        assert [tuple(r)[1:] for r in link_scores(found, 32000, hot_pairs=hot).orderBy("id").collect()] == want


def test_whole_sentence_marks_leave_no_tokens(spark, tools):
    assert rows(spark, ["a ▁ b", "plain"])[0] == (0, 0, 0, 0, "", 0, 0)


def test_long_text_without_spaces(spark, tools):
    texts = ["ab" * 20000, "漢" * 3000, "word " * 20000, "😀\n" * 500]
    assert rows(spark, texts) == corpus(texts, tools)


def test_empty_table_and_repeated_ids(spark, nothing, tools):
    assert link_scores(align(nothing, A, B), 32000).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c"), (None, None)], "doc_id long, text string")
    got = link_scores(align(docs, A, B), 32000).collect()
    assert sorted((r["id"] or 0, r["n_a"], r["count_sum"]) for r in got) == [(0, 0, 0), (0, 1, 1), (1, 2, 4), (1, 2, 4)]


def test_shown_groups_and_columns(spark, awkward, tools):
    for r in align(awkward, A, B, show=True).collect():
        assert hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] or r["groups"] == r["groups_sha256"] == ""


def test_spans_are_refined_by_bytes():
    def ends(spans, sizes):
        starts, stops = (np.array(x, np.int64) for x in zip(*spans))
        return ends_of(starts, stops, np.array(sizes)).tolist()

    # Three tokens share one character of four bytes, then a token of two characters follows.
    assert ends([(0, 4), (0, 4), (0, 4), (4, 6)], [1, 2, 1, 2]) == [1, 3, 4, 6]
    assert ends([(0, 0), (0, 3)], [1, 2]) == [1, 3]


def test_stretches_join_to_the_text():
    for text in ("a b  c", " a", "a \n b", "é 漢 x", "a b"):
        assert " ".join(stretches(text)) == text
    assert stretches("a b\nc d") == ["a", "b\nc", "d"] and stretches("a  b") == ["a  b"]
