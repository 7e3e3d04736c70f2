"""Encoding, token files and packing: exact round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tabsmith.llm import packing, queries, token_files
from tabsmith.llm.tokens import Encoder
from tabsmith.session import scratch_path

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ROWS = [(3, "The cat, the cat.\nAnd it's 3.14!"), (1, None), (2, ""), (5, "日本 naïve  two   spaces \n\n x"), (5, "again"), (9, "the cat " * 3000), (None, "no id"), (7, "<|endoftext|> Σς İ")]


def ids_of(path, text):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_cut_texts_have_the_ids_of_whole_texts(path):
    random.seed(4)
    parts = ["a", "The", " ", "  ", "\n", "\n\n", ".", ",", "'s", "é", "3", "_", "!", "\t", "’", "İ", "Σ", "\xa0", "日", " the", "...", "\x01", "-", "<|endoftext|>"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(4000)]
    enc = Encoder(path, limit=50)  # the cache starts anew all the time
    got = [x for k in range(0, len(texts), 37) for x in enc.encode(texts[k : k + 37])]
    assert got == enc._encode(texts)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_each_word_is_encoded_once_whatever_punctuation_ends_it(path):
    ends = ["", ".", ",", "!", "?!", "***", ".$$$", ")"]
    texts = [f"x {w}{end} {w}{end}" for w in ("lynx", "naïve") for end in ends] + ["", "日本 lynx."]
    enc = Encoder(path)
    asked = []
    for name in ("_encode_words", "_encode"):
        setattr(enc, name, lambda some, real=getattr(enc, name): asked.extend(some) or real(some))
    got = enc.encode(texts)
    assert sorted(a.strip() for a in asked if "lynx" in a or "naïve" in a) == ["lynx", "naïve", "日本 lynx."]
    assert got == Encoder(path)._encode(texts)
    assert enc.encode([]) == [] and enc.encode(["", ""]) == [b"", b""]


def test_a_word_is_looked_up_once_for_millions_of_characters():
    enc = Encoder(BYTE)
    looked, real = [], enc._ids
    enc._ids = lambda pieces: looked.append(sorted(pieces)) or real(pieces)
    texts = ["the lynx " * 120_000 + "ends"] * 3  # a million characters each
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3], "text": texts})
    (block,) = token_files._blocks(iter([batch]), enc, 0, 0, 10_000_000, {})
    assert looked == [["\nthe", "ends", "lynx", "the"]]
    assert block.column("doc_length").to_pylist() == [[len(ids_of(BYTE, texts[0])) + 1] * 3]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_the_cache_keeps_to_its_limit(path):
    random.seed(8)
    words = ["".join(random.choices("abcdefgh", k=6)) for _ in range(300)]
    enc = Encoder(path, limit=50)
    for k in (3, 20, 100, 7, 300, 40):
        texts = [" ".join(words[:k]), " ".join(words[-k:])]
        assert enc.encode(texts) == enc._encode(texts)
        assert len(enc.cache) <= 50


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_punctuation_parts_from_letters_as_in_the_library(path):
    random.seed(6)
    parts = ["a", "Zé", "ª", "²", "3", "_", "'", "'s", "’", "—", "…", " ", " ", "\n", *"!#&(-/:@[`{~|,."]
    texts = ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(4000)]
    enc = Encoder(path)
    assert enc.encode(texts) == enc._encode(texts)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_special_tokens_as_in_the_plain_library(path):
    random.seed(5)
    plain = Tokenizer.from_file(path)
    special = [t.content for t in plain.get_added_tokens_decoder().values()]
    parts = ["a", "The", " ", "\n", ".", "<", "|>", "<|", "endoftext", "3", *special, *map(str.upper, special)]
    texts = ["hello <|endoftext|> x", *["".join(random.choices(parts, k=random.randint(0, 10))) for _ in range(2000)]]
    enc = Encoder(path, limit=50, special_as_text=False)
    got = [np.frombuffer(x, dtype=enc.dtype).tolist() for k in range(0, len(texts), 37) for x in enc.encode(texts[k : k + 37])]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_queries_encode_as_the_plain_library(spark, docs_of, monkeypatch):
    import corpus_pipeline

    text = "hello <|endoftext|> x <|startoftext|>"
    for module in (queries, corpus_pipeline):
        monkeypatch.setattr(module, "table", lambda *_: docs_of([(1, text)]))
    want = {p: Tokenizer.from_file(p).encode(text, add_special_tokens=False).ids + [end] for p, end in ((BYTE, 0), (WORD, 2))}
    crc = {p: zlib.crc32(np.array(ids, dtype="<u4").tobytes()) for p, ids in want.items()}
    r = queries.op10_token_files(spark, "").collect()[0]
    assert (r.n_tokens, r.ids_crc32) == (len(want[BYTE]), crc[BYTE])
    for pieces in (queries.op3_packing(spark, ""), corpus_pipeline.packed(spark, docs_of([(1, text)]), "")):
        found = pieces.collect()
        assert sum(r.length for r in found) == len(want[WORD])
        assert len(found) > 1 or found[0].ids_crc32 == crc[WORD]


@pytest.mark.parametrize("seed", range(4))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 60, 200)
    ids = rng.choice([1, 2, 3, 4, 400], size=lengths.sum(), p=[0.4, 0.3, 0.2, 0.09, 0.01])
    symbols, per_doc, rules, rule_lengths = token_files.compress(ids, lengths, 401, rounds=5, pairs=16, min_count=2)
    assert len(rules) and len(symbols) < len(ids)
    assert (token_files.expand(symbols, rules, 401) == ids).all()
    at = 0
    for n, length in zip(per_doc, lengths, strict=True):  # no symbol spans two documents
        assert len(token_files.expand(symbols[at : at + n], rules, 401)) == length
        at += n
    block = {"symbols": symbols.astype("<u2").tobytes(), "rules": rules.astype("<u2").tobytes(), "rule_length": rule_lengths, "width": 2, "n_terminals": 401}
    for start, stop in ((0, 1), (5, 5), (7, 90), (len(ids) - 3, len(ids))):
        assert (token_files.read_range(block, start, stop) == ids[start:stop]).all()


def test_grammar_of_next_to_nothing():
    for ids in ([0], [0, 0], [1] * 40):
        symbols, per_doc, rules, _ = token_files.compress(np.array(ids), np.array([len(ids)]), 2, min_count=2)
        assert token_files.expand(symbols, rules, 2).tolist() == ids and per_doc.tolist() == [len(symbols)]


@pytest.mark.parametrize("block_ids", [10, 1_000_000])
def test_token_files_round_trip(spark, docs_of, block_ids):
    path = scratch_path(spark, "t")
    token_files.write_token_files(docs_of(ROWS), path, BYTE, block_ids=block_ids, min_count=2)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 5, 5, 7, 9]
    place, texts = 0, {}
    for i, t in ROWS:
        texts.setdefault(i, []).append(ids_of(BYTE, t) + [0])
    for r in got:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert r.start == place and r.n_tokens == len(ids) and ids in texts[r.doc_id]
        texts[r.doc_id].remove(ids)
        place += len(ids)


def test_token_files_of_an_empty_table(spark, docs_of):
    path = scratch_path(spark, "t")
    token_files.write_token_files(docs_of([]), path, BYTE)
    assert token_files.read_token_files(spark, path).count() == 0


@pytest.mark.parametrize("length", [16, 4096])
def test_every_id_is_packed_once(docs_of, length):
    got = packing.pack(docs_of(ROWS), WORD, length=length).collect()
    want = sorted(((i or -1), tuple(ids_of(WORD, t) + [2])) for i, t in ROWS)
    pieces, sequences = {}, {}
    for r in got:
        assert len(r.ids) == 4 * r.length
        pieces.setdefault((r.doc_id or -1, r.doc_tokens), []).append((r.start, r.ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    back = sorted((i, tuple(np.frombuffer(b"".join(x for _, x in sorted(p)), dtype="<u4").tolist())) for (i, _), p in pieces.items())
    assert back == want
    for parts in sequences.values():
        total = 0
        for offset, size in sorted(parts):
            assert offset == total
            total += size
        assert total <= length and total & (total - 1) == 0  # full, or a power of two: no padding


def test_packing_of_an_empty_table(docs_of):
    assert packing.pack(docs_of([]), WORD).count() == 0


def test_cuts_tile_the_run():
    for total in (1, 15, 16, 17, 45, 64, 77):
        seen = []
        place = 0
        for n in (7, 1, 30, total):
            n = min(n, total - place)
            seen += [(sequence, offset, stop - start) for start, stop, sequence, offset in packing.cuts(place, n, total, 16)]
            place += n
        assert sum(s[2] for s in seen) == total
        ends = {}
        for sequence, offset, size in seen:
            assert ends.get(sequence, 0) == offset
            ends[sequence] = offset + size
        assert sorted(ends) == list(range(len(ends)))
        assert all(e == 16 or e & (e - 1) == 0 for e in ends.values())


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve_visits_all_neighbours_once(dims, bits):
    points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    keys = packing.hilbert_key(points, bits)
    assert sorted(keys) == list(range(len(points)))
    path = points[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_similar_documents_are_neighbours(docs_of):
    near = "alpha beta gamma delta " * 40
    rows = [(k, near + f"w{k}") for k in range(6)] + [(100 + k, f"other{k} thing{k * 7} {'xyz' * k} " * 40) for k in range(30)]
    got = packing.pack(docs_of(rows), WORD).orderBy("sequence_id", "offset").collect()
    order = [r.doc_id for r in got if r.start == 0]
    places = [order.index(k) for k in range(6)]
    assert max(places) - min(places) <= 12


def test_crc_of_pieces(docs_of):
    r = packing.pack(docs_of([(1, "the cat")]), WORD).orderBy("start").collect()
    assert zlib.crc32(b"".join(x.ids for x in r)) == zlib.crc32(np.array(ids_of(WORD, "the cat") + [2], dtype="<u4").tobytes())
