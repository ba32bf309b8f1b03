import numpy as np
import pytest

from shelfcast.llm import packing
from tests.llm.helpers import frame, prose

public_tokenizers = pytest.importorskip("public_tokenizers")
ODD = "ΑΣ Σ a̸ ̸b é x<|endoftext|>y <|STARTOFTEXT|> <|startoftext|> z İI 'S don't 12ab \x85q \x1c\x1d k !!! a.b,c ½ ²x"


def encoder(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_word_ids_equal_the_tokenizer(name):
    texts = ["", " ", ODD, prose(1, 300), "x" * 5000, "The the THE the, the. (the)", "́e ẛ̣"]
    plain = encoder(name)
    made = packing.WordIds(public_tokenizers.path(name), known=5)
    for _ in range(2):
        got = made([t.encode() for t in texts])
        assert [np.frombuffer(g, dtype="<u4").tolist() for g in got] == [plain(t) for t in texts]


@pytest.mark.parametrize("sizes", [[], [1], [2048], [2048, 2048], [1000, 1048, 1], [700] * 9, list(range(1, 400)), [2047] * 3 + [1] * 3])
def test_windows_hold_every_part_once_and_never_too_much(sizes):
    at = packing.pack(np.array(sizes, dtype=np.int64), 2048)
    assert len(at) == len(sizes)
    filled = np.bincount(at, weights=sizes) if sizes else np.zeros(0)
    assert filled.max(initial=0) <= 2048 and sum(filled) == sum(sizes)


def test_differencing_is_near_equal():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 2000, 300)
    filled = np.bincount(packing.difference_windows(sizes, 30), weights=sizes, minlength=30)
    assert filled.max() - filled.min() < 0.02 * filled.mean()
    classic = np.array([8, 7, 6, 5, 4])  # differencing ends with 14 and 16
    assert sorted(np.bincount(packing.difference_windows(classic, 2), weights=classic)) == [14, 16]


ROWS = [(i, prose(i, 40 + 37 * i % 900)) for i in range(120)] + [(200, None), (201, ""), (None, "null id"), (202, "same"), (202, "same"), (203, prose(9, 9000)), (204, ODD)]


def test_pieces_cover_each_document_and_fill_sequences_without_gaps(spark):
    plain = encoder("word_bpe_49k.json")
    pieces = packing.pack_documents(frame(spark, ROWS), public_tokenizers.path("word_bpe_49k.json")).collect()
    want = {}
    for d, t in ROWS:
        want.setdefault(d, []).append(plain(t) + [1])
    got = {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], dtype="<u4").tolist()
        assert len(ids) == p["length"] > 0
        got.setdefault(p["doc_id"], []).append((p["start"], ids, p["doc_tokens"]))
    for d, texts in want.items():
        parts = sorted(got[d])
        assert sum(len(x[1]) for x in parts) == sum(map(len, texts))
        if len(texts) == 1:
            joined = [i for x in parts for i in x[1]]
            assert joined == texts[0] and [x[0] for x in parts] == np.cumsum([0] + [len(x[1]) for x in parts])[:-1].tolist()
            assert {x[2] for x in parts} == {len(joined)}
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    total = 0
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
    assert total == sum(len(t) for texts in want.values() for t in texts)


def test_empty_table(spark):
    assert packing.pack_documents(frame(spark, ROWS).limit(0), public_tokenizers.path("word_bpe_49k.json")).collect() == []
