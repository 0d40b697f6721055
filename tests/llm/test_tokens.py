"""Token files and packing against plain encoding."""

import inspect
import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sievegate.llm import arrays, packing, token_files, tokens
from sievegate.llm.tokens import PieceEncoder, tokenizer_path

WORD_FILE, BYTE_FILE = "word_bpe_49k.json", "byte_bpe_50k.json"


def plain(name):
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def odd_texts():
    random.seed(8)
    parts = ["a", "It's", "we'll", "  ", " ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", " ", " ",
             "é", "́", "É", "Σας", "12", "３", "…", "don't'", "<|endoftext|>", "漢字", "🙂", "#$%", "x" * 90, "‍"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(1500)]
    return texts + ["", None, " ", "\n", "word", "J̌", "ǰ", "É", "WORD Word word", " lead", "trail ", "trail\n", "  x", "x   y", " ́a"]


@pytest.mark.parametrize("name", [WORD_FILE, BYTE_FILE])
def test_pieces_give_the_ids_of_the_whole_text(name):
    texts, ids_of = odd_texts(), plain(name)
    ids, bounds = PieceEncoder(tokenizer_path(name), name == BYTE_FILE).encode(pa.array(texts).slice(0))
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == ids_of(text), repr(text)


@pytest.mark.parametrize("name", [WORD_FILE, BYTE_FILE])
def test_runs_of_mixed_white_space_are_encoded_whole(name):
    rng, ids_of = random.Random(12), plain(name)
    texts = [f"x{' \u00a0' * n} y" for n in (1, 2, 4, 8, 16)] + [f"{'\u00a0 ' * n}y" for n in (1, 2, 4)]
    parts = [*arrays.SPACES.decode(), *arrays.WIDE_SPACES, " ", " ", "\u00a0", "\u00a0", "\x1c", "\u200b", "a", "é", "漢", "1", "'s", "!"]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(3000)]
    ids, bounds = PieceEncoder(tokenizer_path(name), name == BYTE_FILE).encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == ids_of(text), repr(text)


@pytest.mark.parametrize("name", [WORD_FILE, BYTE_FILE])
def test_memory_of_an_encoder_is_bounded_by_parts_of_a_batch(name):
    texts = [" ".join(f"word{(i * j) % 977}" for j in range(1000)) for i in range(1000)]
    encoder = PieceEncoder(tokenizer_path(name), name == BYTE_FILE)
    tracemalloc.start()
    ids, bounds = encoder.encode(pa.array(texts))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 80 << 20
    for i in (0, 1, 500, 999):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == plain(name)(texts[i])


def test_an_encoder_that_remembers_little_gives_the_same_ids():
    texts = [" ".join(f"w{i * 7 + j}" for j in range(30)) for i in range(40)]
    encoder, ids_of, most = PieceEncoder(tokenizer_path(BYTE_FILE), remembered=50), plain(BYTE_FILE), 0
    for text in texts:
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == ids_of(text)
        most = max(most, len(encoder._memory))
    assert most <= 50 + 30


def test_packing_alone_encodes_no_piece_twice():
    """420,000 distinct words, as a worker meets them in a few documents of a large table."""
    remembered = inspect.signature(packing.pack_documents).parameters["remembered"].default
    encoder, learned = PieceEncoder(tokenizer_path(BYTE_FILE), remembered=remembered), []
    learn = encoder._learn
    encoder._learn = lambda fresh: (learned.append(len(fresh)), learn(fresh))
    texts = pa.array(["".join(f" w{i}" for i in range(a, a + 70_000)) for a in range(0, 420_000, 70_000)])
    first, _ = encoder.encode(texts)
    assert sum(learned) == 420_000
    again, _ = encoder.encode(texts)
    assert sum(learned) == 420_000 and (first == again).all()


def test_a_forgotten_encoder_is_made_anew():
    path = tokenizer_path(BYTE_FILE)
    tokens.forget_encoder(path, remembered=9)
    one = tokens.encoder_for(path, remembered=9)
    assert tokens.encoder_for(path, remembered=9) is one
    tokens.forget_encoder(path, remembered=9)
    assert tokens.encoder_for(path, remembered=9) is not one


def test_codes_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    for ids in (np.zeros(0, int), np.array([0]), np.array([255, 256, 65535, 65536, 2**32 - 1]),
                rng.integers(0, 60_000, 5_000), rng.integers(0, 256, 513), rng.integers(0, 2**31, 2_000)):
        codes = token_files.Codes(token_files.pack_codes(ids.astype(np.uint32)))
        assert len(codes) == len(ids) and codes.all().tolist() == ids.tolist()
        for place in rng.integers(0, len(ids), 200) if len(ids) else []:
            assert codes[int(place)] == ids[place]


def checksum(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_hold_every_document_in_order(rows_of):
    texts = [f"Some words {i} \n more" * (i % 7) for i in range(60)] + ["", None, "same", "same"]
    rows = [(i * 3 % 61, t) for i, t in enumerate(texts)]
    got = token_files.token_index(rows_of(rows), tokenizer_path(WORD_FILE), spaces_matter=False).collect()
    ids_of, at = plain(WORD_FILE), 0
    want = []
    for doc_id, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "")):
        ids = ids_of(text) + [2]
        want.append((doc_id, at, len(ids), checksum(ids)))
        at += len(ids)
    assert sorted(map(tuple, got)) == sorted(want)
    empty = token_files.token_index(rows_of(rows).limit(0), tokenizer_path(WORD_FILE))
    assert empty.count() == 0


def test_pool_is_cut_without_loss_or_padding():
    rng = random.Random(2)
    for n in (1, 2, 50, 400):
        lengths = [rng.choice([1, 3, 255, 256, 257, 1024, 2047, 2048, 2049, 9000, rng.randint(1, 3000)]) for _ in range(n)]
        sequences = packing.pack_pool(lengths)
        spans = defaultdict(list)
        for row in sequences:
            size = sum(p[2] for p in row)
            assert size <= 2048 and size & (size - 1) == 0
            for document, start, length in row:
                spans[document].append((start, length))
        for document, length in enumerate(lengths):
            at = 0
            for start, size in sorted(spans[document]):
                assert start == at and size > 0
                at += size
            assert at == length
        groups = packing.balanced_groups(sequences)
        assert len(groups) == len(sequences) and max(np.bincount(groups)) <= packing.STEP_SEQUENCES
    assert packing.pack_pool([]) == []


def test_packed_documents_cover_every_token(rows_of):
    texts = [("alpha beta gamma " * (i * 37 % 900)) for i in range(40)] + ["", None, "dup", "dup"]
    rows = list(enumerate(texts)) + [(43, "dup"), (None, "no id")]
    got = packing.pack_documents(rows_of(rows), tokenizer_path(BYTE_FILE)).collect()
    ids_of, pieces, sequences = plain(BYTE_FILE), defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == {r[0] for r in rows}
    for doc_id, text in rows:
        ids, copies = ids_of(text) + [1], 2 if doc_id == 43 else 1
        assert sum(p.length for p in pieces[doc_id]) == copies * len(ids)
        for p in pieces[doc_id]:
            assert p.doc_tokens == len(ids) and p.ids_crc32 == checksum(ids[p.start : p.start + p.length])
    for found in sequences.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == found[0].tier <= 2048
    assert packing.pack_documents(rows_of(rows).limit(0), tokenizer_path(BYTE_FILE)).count() == 0
