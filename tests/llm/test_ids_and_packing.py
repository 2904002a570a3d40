"""Tokens as the library makes them, Simple-8b round trips, files of ids, packing."""

import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pluvio.llm import idfiles, packing, simple8b, tokens
from pluvio.llm.tokens import Encoder, path_of

ODD = ["", "  a  b\n\n c", "don't I'LL'll 's's 'sam !'s ''s x 're", "a<|endoftext|>b", "İstanbul ǅ ﬁ Å é", "漢字 かな", "x²½ 12 ٣", "😀 a😀b",
       "\x1c\x85 a", "a\r\n\tb   ", "Σας ΣΑΣ", "é É", "'t", "'", "x'll", "'ll ama'llama", "\xa0a \xa0 b"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(monkeypatch, name):
    rng = random.Random(5)
    letters = list("ab sS'tdmrevl  \n\t12²½!?é\xa0ÀıİЖ漢’—A")
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    own, library = Encoder(path_of(name), remember=500), Tokenizer.from_file(path_of(name))
    monkeypatch.setattr(tokens, "SECTION", 50)
    for text, got in zip(texts, own.encode(texts), strict=True):
        assert got.tolist() == library.encode(text, add_special_tokens=False).ids, text
    big = "".join(rng.choice(letters) for _ in range(5000))
    assert own.encode([big])[0].tolist() == library.encode(big, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b_round_trip(values):
    v = np.array(values, np.uint64)
    blocks = simple8b.encode_blocks(v, 256)
    back = [simple8b.decode_block(b) for b in blocks]
    assert (np.concatenate([np.zeros(0, np.uint64), *back]) == v).all() and all(len(b) <= 256 for b in back)


def test_simple8b_packs_tightly():
    assert len(simple8b.encode_blocks(np.zeros(4096, np.uint64))[0]) < 200
    ids = np.random.default_rng(0).integers(0, 1 << 15, 4096).astype(np.uint64)
    rare = ids.copy()
    rare[100] = 1 << 40
    one, other = simple8b.encode_blocks(ids)[0], simple8b.encode_blocks(rare)[0]
    assert len(one) <= 12 + 8 * 1024 and len(other) <= len(one) + 10


def test_id_files(spark, tmp_path):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["the", "cat", "Sat", "x1"]) for _ in range(rng.randint(0, 900)))) for k in range(300)]
    rows += [(300, None), (301, ""), (5, "again"), (None, "nobody"), (302, "long " * 60_000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_tokens", "2 AS start").repartition(3)
    files = idfiles.write(docs, str(tmp_path), path_of("byte_bpe_50k.json"), docs_per_file=60)
    assert files.count() > 3
    got = sorted((tuple(r) for r in idfiles.read(files).collect()), key=lambda r: r[1])
    library = Tokenizer.from_file(path_of("byte_bpe_50k.json"))
    ids = {}
    for doc, text in rows:
        ids.setdefault(doc, []).append([*library.encode(text or "", add_special_tokens=False).ids, 2])
    assert [r[0] for r in got] == [None, *sorted(d for d, _ in rows if d is not None)]
    start = 0
    for doc, begin, n, check in got:
        assert begin == start
        assert (n, check) in {(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[doc]}
        start += n
    first = files.orderBy("shard").first()
    system, name = idfiles._place(first.path)
    with system.open_input_file(name) as f:
        reader = idfiles.Reader(f)
        for k in (0, 1, len(reader.docs) - 1):
            doc = None if reader.docs[k] == idfiles.NULL_ID else int(reader.docs[k])
            assert reader.document(k).tolist() in ids[doc]
    empty = idfiles.write(docs.limit(0), str(tmp_path), path_of("byte_bpe_50k.json"))
    assert idfiles.read(empty).count() == 0


def placed(bins, lengths, capacity):
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(0 < sum(lengths[i] for i in b) <= capacity for b in bins)
    return len(bins)


def test_local_search_empties_bins():
    rng = np.random.default_rng(0)
    before = after = 0
    for _ in range(10):
        lengths = rng.integers(20, 35, 120)
        start = packing.best_fit(lengths, 100)
        end = packing.improve([list(b) for b in start], lengths, 100)
        before += placed(start, lengths, 100)
        after += placed(end, lengths, 100)
        squares = [sum(int(lengths[b].sum()) ** 2 for b in x) for x in (start, end)]
        assert squares[1] >= squares[0]
    assert after < 0.97 * before


def test_packing_is_whole(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(["word"] * rng.choice([0, 3, 40, 300, 900, 5000]))) for k in range(400)] + [(7, None), (7, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS sequence_id", "'x' AS length")
    cut = packing.pieces(docs, path_of("word_bpe_49k.json"))
    out = packing.pack(cut, group=150).collect()
    library = Tokenizer.from_file(path_of("word_bpe_49k.json"))
    want = sorted(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.start == 2048 * r.piece
    assert sum(r.length for r in out) == sum(want) and len(out) == sum(-(-n // 2048) for n in want)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    alone = packing.best_fit(np.array([r.length for r in out]), 2048)
    assert len(sequences) <= len(alone) + 1
    assert packing.pack(packing.pieces(docs.limit(0), path_of("word_bpe_49k.json"))).count() == 0


def thue_morse(n):
    """Two words whose sums of letters times powers of any odd number agree modulo 2**64."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_that_collide_in_polynomial_hashes_have_their_own_ids(name):
    a, b = thue_morse(1024)
    enc = Encoder(path_of(name))
    texts = [f"x {a} y", f"x {b} y", a, b]
    assert [x.tolist() for x in enc.encode(texts)] == [enc.whole.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pretokens_of_one_hash_are_told_apart(name, monkeypatch):
    from pluvio.llm import tokens

    monkeypatch.setattr(tokens, "run_hashes", lambda codes, starts, ends: (ends - starts).astype(np.uint64) % 5)
    enc = Encoder(path_of(name))
    texts = ["the quick brown fox", "", "jumps over the lazy dog's back 12 34", "the the fox", "a" * 50 + " " + "b" * 50]
    for _ in range(2):
        assert [x.tolist() for x in enc.encode(texts)] == [enc.whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_search_stops_only_where_no_exchange_helps():
    """No move, exchange, two for one or one for two between two underfull sequences raises the squared fill, whatever their sizes."""
    rng = np.random.default_rng(4)
    for capacity, low, high, n in ((60, 5, 40, 60), (400, 1, 12, 300), (100, 20, 60, 80)):
        lengths = rng.integers(low, high, n)
        bins = [x for x in packing.improve(packing.best_fit(lengths, capacity), lengths, capacity) if lengths[x].sum() < capacity]
        for giver in bins:
            for target in bins:
                room = capacity - lengths[target].sum()
                if giver is target or lengths[target].sum() < lengths[giver].sum():
                    continue
                outs = [sum(c) for k in (1, 2) for c in itertools.combinations(lengths[giver].tolist(), k)]
                backs = [sum(c) for k in (0, 1, 2) for c in itertools.combinations(lengths[target].tolist(), k)]
                singles = set(lengths[giver].tolist())
                allowed = {o - b for o in singles for b in backs} | {o - b for o in outs for b in lengths[target].tolist()}
                assert not any(0 < gain <= room for gain in allowed)
