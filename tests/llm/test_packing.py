import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from episoda.llm import packing, queries, token_output, tokens
from tests.llm.helpers import SF, awkward_rows, docs_of


def library():
    t = Tokenizer.from_file(tokens.default_path("word_bpe_49k.json"))
    t.no_truncation(), t.no_padding()
    return t


def expected_pieces(rows, capacity=2048):
    t, out = library(), []
    for doc, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            out.append((-1 if doc is None else doc, k, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out)


def check_places(rows, capacity=2048):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query_matches_the_library(spark):
    rows = queries.op1_best_fit_packing(spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected_pieces(docs)
    total = sum(r.length for r in rows)
    assert check_places(rows) <= -(-total // 2048) + 1


def test_awkward_rows(spark):
    rows = awkward_rows()
    got = packing.pack(docs_of(spark, rows)).collect()
    want = expected_pieces([(r[0], r[1]) for r in rows])
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in got) == want
    check_places(got)


def test_empty_table(spark):
    assert packing.pack(docs_of(spark, [])).count() == 0
    assert token_output.token_matrices(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_each_piece_once_and_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    counts = np.bincount(np.clip(rng.lognormal(4, 1.2, 4000).astype(int), 1, 255), minlength=257)
    counts[256] = 0
    plan = packing.make_plan(counts, 256)
    used = np.zeros(257, int)
    for p, k in plan:
        assert k > 0 and sum(s * m for s, m in p.items()) <= 256
        for s, m in p.items():
            used[s] += k * m
    assert (used == counts).all()
    _, bound = packing.configuration_lp(counts, 256)
    made = sum(k for _, k in plan)
    assert bound - 1e-6 <= made <= 1.01 * bound + 2


def test_bound_beats_mass_where_halves_do_not_fit():
    counts = np.zeros(101, int)
    counts[60] = 10
    cover, bound = packing.configuration_lp(counts, 100)
    assert bound == pytest.approx(10)
    assert sum(k for _, k in packing.make_plan(counts, 100)) == 10
    assert cover


def test_segment_tree_is_best_fit():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 65, 500).tolist()
    free: list[int] = []
    for n in sorted(lengths, reverse=True):  # brute force
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - n)
        else:
            free.append(64 - n)
    rows = token_output.best_fit_decreasing(lengths, 64)
    assert sorted(i for r in rows for i in r) == list(range(500))
    assert len(rows) == len(free)
    assert sorted(64 - sum(lengths[i] for i in r) for r in rows) == sorted(free)


def test_matrices_hold_every_document_without_loss(spark):
    rows = awkward_rows()
    got = token_output.token_matrices(docs_of(spark, rows), capacity=256, block_ids=5000).collect()
    t = library()
    want = sorted([str(r[0]), *(t.encode(r[1] or "", add_special_tokens=False).ids + [0])] for r in rows) if False else sorted((str(r[0]), tuple(t.encode(r[1] or "", add_special_tokens=False).ids + [0])) for r in rows)
    parts = defaultdict(list)
    assert len({r.sequence_id for r in got}) == len(got)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_ids <= 256 and not ids[r.n_ids :].any()
        assert list(r.position_resets) == list(r.cu_seqlens[:-1])
        pos = token_output.positions(r.cu_seqlens, 256)
        assert all(pos[a] == 0 and pos[b - 1] == b - a - 1 for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]))
        for doc, piece, start, a, b in zip(r.doc_ids, r.pieces, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert start == piece * 256
            parts[doc].append((piece, tuple(ids[a:b].tolist())))
    joined = []
    for doc, own in parts.items():
        docs: list[tuple] = []
        copies = sum(p == 0 for p, _ in own)
        if copies == 1:
            docs = [sum((x for _, x in sorted(own)), ())]
        else:
            docs = [x for _, x in own]
        joined += [(str(doc), d) for d in docs]
    assert sorted(joined) == want


def test_characters_below_the_letter_extensions_in_context():
    """Every character below U+0250 beside letters, digits and symbols, and chunks of other scripts, against the library."""
    encoder, lib = tokens.word_encoder(tokens.default_path("word_bpe_49k.json")), library()
    texts = [f"{c}\u00b7 a{c}b {c}{c} 1{c}2 .{c}" for c in map(chr, range(0x250))]
    rng = np.random.default_rng(3)
    some = [chr(c) for c in (*range(0x20, 0x250), 0x301, 0x307, 0x3A3, 0x3C2, 0x2019, 0x201C, 0x2014, 0x2003, 0x2028, 0x3000, 0x4E2D, 0x65E5, 0xAC00, 0x1100, 0x1161, 0x1E9E, 0x212B, 0xFB01, 0x1F600, 0x10400, 0x1C, 0x85, 0xA0, 9, 10)]
    texts += ["".join(rng.choice(some, rng.integers(0, 14))) for _ in range(6000)]
    texts += ["e\u0301 e \u0301 \u0301e", "\u201cquoted\u201d \u2014 it\u2019s", "ΟΔΟΣ ΟΔΟΣ.", "<|endoftext|> \u2019 <|startoftext|>x"]
    for t in texts:
        want = np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encode(t) == want == encoder.encode(t), ascii(t)


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        tokens.WordEncoder(tokens.default_path("byte_bpe_50k.json"))
