from __future__ import annotations

import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from civicmart.llm import packing
from civicmart.llm.queries import tokenizer_path

WORDS = "alpha beta gamma delta naïve straße 北京 don't 1234 3.14 e-mail --- (x) end.".split()


@lru_cache
def plain_tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def plain_ids(text):
    return [*plain_tokenizer().encode(text or "", add_special_tokens=False).ids, packing.END_TOKEN]


def checked(rows, out, window):
    """Each id lies in one piece, sequences have no gap, and only powers of two are short."""
    ids = {i: plain_ids(t) for i, t in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for doc, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[doc])
            piece = np.array(ids[doc][at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(piece) and bytes(r.ids) == piece
            at += r.length
        assert at == len(ids[doc])
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or (at < window and at & (at - 1) == 0)
    assert sum(r.length for r in out) == sum(map(len, ids.values()))


@pytest.mark.parametrize("shard_tokens", [1 << 20, 700])
def test_pieces_hold_every_id_once(spark, docs, shard_tokens):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.choice([1, 5, 40, 300])))) for i in range(90)]
    rows += [(90, None), (91, ""), (92, " \n\t "), (93, "word " * 6000)]
    out = packing.pack(docs(rows), tokenizer_path(), window=256, shard_tokens=shard_tokens).collect()
    checked(rows, out, 256)


def test_repeats_null_ids_and_empty(spark, docs):
    rows = [(1, "alpha beta"), (1, "alpha beta"), (None, "gamma")]
    out = packing.pack(docs(rows), tokenizer_path()).collect()
    assert sum(r.length for r in out) == sum(len(plain_ids(t)) for _, t in rows)
    assert {r.doc_id for r in out} == {1, None}
    assert packing.pack(docs([]), tokenizer_path()).count() == 0


def test_windows_hold_the_target_proportions(spark, docs):
    rows = [(i, "alpha beta gamma delta " * 10) for i in range(300)]
    targets = {"src0": 0.5, "src1": 0.25, "src2": 0.25}
    out = packing.pack(docs(rows), tokenizer_path(), targets=targets, window=1024).collect()
    checked(rows, out, 1024)
    early = [r for r in out if r.sequence_id < 4]
    share = sum(r.length for r in early if r.doc_id % 3 == 0) / sum(r.length for r in early)
    assert abs(share - 0.5) < 0.15


def test_pieces_are_given_out_by_bytes(spark, monkeypatch):
    """A batch of long documents gives several batches of pieces, the same pieces in all."""
    from unittest.mock import MagicMock

    import pandas as pd

    from civicmart.llm import packing

    rows, runs = MagicMock(), MagicMock()
    rows.agg.return_value.first.return_value = [100]
    monkeypatch.setattr(packing, "tokenized", lambda *_: rows)
    monkeypatch.setattr(packing, "shares", lambda *_: None)
    monkeypatch.setattr(packing, "pieces", lambda *_: runs)
    monkeypatch.setattr(packing, "_PIECE_BYTES", 100, raising=False)
    monkeypatch.setattr(packing, "WordTokens", lambda _: MagicMock(width="<u2"))
    packing.pack(None, "", window=64)
    joined = rows.select.return_value.join.return_value.select.return_value
    cut = joined.mapInPandas.call_args[0][0]
    ids = bytes(range(40))
    batch = pd.DataFrame(
        [(i, False, 20, ids, [{"start": 0, "length": 20, "at": 20 * i}]) for i in range(5)],
        columns=["doc_id", "unknown", "doc_tokens", "ids", "runs"],
    )
    out = list(cut(iter([batch])))
    assert len(out) == 3 and sum(len(o) for o in out) == 7
    assert sum(int(o["length"].sum()) for o in out) == 100


def test_words_are_tokenized_once_a_batch_and_kept_in_bounds(monkeypatch):
    """Half a million kept words and as many objects took most of a worker's memory, and a look-up for each occurrence its time."""
    monkeypatch.setattr(packing, "WORDS_KEPT", 6)
    monkeypatch.setattr(packing, "RUNS_KEPT", 5)
    tokens = packing.WordTokens(tokenizer_path())
    rng = random.Random(3)
    texts = ["".join(rng.choice(WORDS) + rng.choice([" ", "\n", "  ", ", "]) for _ in range(rng.randrange(40))) for _ in range(200)]
    asked = []
    tokenize = tokens.runs.tokenize
    tokens.runs.tokenize = lambda runs: asked.append(sorted(runs)) or tokenize(runs)
    for part in (texts[:100], texts[100:], texts[:50], ["", "  "], []):
        expected = [np.array(plain_ids(t)[:-1], tokens.width).tobytes() for t in part]
        assert tokens.encode(part) == expected
    assert all(len(set(runs)) == len(runs) for runs in asked)
    assert len(tokens.words.rows) <= 7 and len(tokens.runs.rows) <= 6
