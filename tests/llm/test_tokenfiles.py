from __future__ import annotations

import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civicmart.llm import tokenfiles
from civicmart.llm.queries import byte_tokenizer_path

TEXTS = [
    "The house, the garden. The house's owner don't care!",
    "a  b   c\n\n\nd \n e\t\tf",
    " leading and trailing ",
    "\nline\n",
    "ends with two \n",
    "a\n\nb  c\n d \ne",
    "Élève à l'école: 12,5 € — naïve café non-breaking 数字 ½²",
    "x<|endoftext|>y <|endoftext|",
    "",
    None,
    "\n",
    "  ",
    " ",
    "word" * 3000 + " " + "tail \n" * 500,
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_tokenizer_path())


def plain(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def expected(tokenizer, rows):
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain(tokenizer, text)
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(df):
    rows = tokenfiles.with_crc32(tokenfiles.read_documents(df)).select("doc_id", "start", "n_tokens", "ids_crc32")
    return sorted(map(tuple, rows.collect()), key=lambda r: r[1])


def test_equals_plain_tokenizing_in_order(spark, docs, tokenizer):
    rows = [(97 * i % 101, TEXTS[i % len(TEXTS)]) for i in range(101)] + [(None, "no id")]
    index = tokenfiles.write_tokens(docs(rows).repartition(5), byte_tokenizer_path(), file_tokens=5000)
    assert index.count() > 4
    assert written(index) == expected(tokenizer, rows)


def test_cached_stretches_equal_plain_tokenizing_over_many_batches(tokenizer):
    tokens = tokenfiles.ChunkTokens(byte_tokenizer_path())
    for _ in range(3):
        for text, ids in zip(TEXTS, tokens.encode([t or "" for t in TEXTS])):
            assert np.frombuffer(ids, tokens.width).tolist() == plain(tokenizer, text)[:-1]


def test_generations_of_the_cache(monkeypatch, tokenizer):
    monkeypatch.setattr(tokenfiles, "CHUNKS_KEPT", 5)
    tokens = tokenfiles.ChunkTokens(byte_tokenizer_path())
    for text in ["one two three", "two four five six", "one six seven eight", "one two three four"] * 3:
        assert np.frombuffer(tokens.encode([text])[0], tokens.width).tolist() == plain(tokenizer, text)[:-1]


def test_any_token_by_random_access(spark, docs, tokenizer):
    rows = [(i, f"{TEXTS[i % len(TEXTS)] or ''} number {i}") for i in range(60)]
    index = tokenfiles.write_tokens(docs(rows), byte_tokenizer_path(), file_tokens=3000)
    whole = [t for _, text in rows for t in plain(tokenizer, text)]
    wanted = spark.range(-5, len(whole) + 5, 7).withColumnRenamed("id", "position")
    got = {r.position: r.token for r in tokenfiles.tokens_at(index, wanted).collect()}
    assert got == {p: whole[p] for p in range(-5, len(whole) + 5, 7) if 0 <= p < len(whole)}


@pytest.mark.parametrize("bits", [8, 16])
@pytest.mark.parametrize("top", [1, 200, 256, 65536, 1 << 32])
def test_codes_round_trip(bits, top):
    rng = np.random.default_rng(top)
    ids = np.minimum(rng.integers(0, top, 3000), rng.integers(0, top, 3000)).astype(np.uint32)
    counts = np.array([0, 1000, 1, 1999])
    data = b"".join(tokenfiles.packed(ids, [None, 4, 4, 9], counts, bits))
    opened = tokenfiles.TokenFile(pa.BufferReader(data))
    assert (opened.ids() == ids).all()
    assert [opened.token(i) for i in range(3000)] == ids.tolist()
    assert opened.documents()[0] == [None, 4, 4, 9]
    assert opened.documents()[1].tolist() == [0, 0, 1000, 1001, 3000]
    with pytest.raises(IndexError):
        opened.token(3000)


def test_random_access_reads_little(spark):
    ids = np.random.default_rng(1).integers(0, 50000, 200_000).astype(np.uint32)
    data = b"".join(tokenfiles.packed(ids, [1], np.array([len(ids)])))

    class Counting:
        def __init__(self):
            self.file, self.read = io.BytesIO(data), 0

        def size(self):
            return len(data)

        def read_at(self, n, at):
            self.read += n
            return data[at : at + n]

    file = Counting()
    opened = tokenfiles.TokenFile(file)
    file.read = 0
    assert opened.token(123_456) == ids[123_456]
    assert file.read <= 2 * (1 + 8 + tokenfiles.RANK_BITS // 8)


def test_broken_files_are_errors():
    data = b"".join(tokenfiles.packed(np.arange(10, dtype=np.uint32), [1], np.array([10])))
    for broken in (data[:-1], b"x" + data[1:], data[:20], b"", data[:30] + data[31:]):
        with pytest.raises(ValueError):
            tokenfiles.TokenFile(pa.BufferReader(broken))


def test_empty_table_and_repeated_rows(spark, docs, tokenizer):
    assert written(tokenfiles.write_tokens(docs([]), byte_tokenizer_path())) == []
    rows = [(7, "same text")] * 50 + [(None, None)] * 3
    assert written(tokenfiles.write_tokens(docs(rows), byte_tokenizer_path())) == expected(tokenizer, rows)


def test_extra_columns_are_ignored(spark, docs, tokenizer):
    rows = [(3, "three"), (1, "one")]
    clash = docs(rows).withColumns({c: F.lit("x") for c in ("h", "row", "part", "base", "name", "ids")})
    assert written(tokenfiles.write_tokens(clash, byte_tokenizer_path())) == expected(tokenizer, rows)


def test_stretches_are_tokenized_once_a_batch(monkeypatch, tokenizer):
    """Each occurrence used to be looked up and joined by itself, with five times as many stretches kept."""
    from civicmart.llm import pieces

    monkeypatch.setattr(tokenfiles, "CHUNKS_KEPT", 8)
    monkeypatch.setattr(pieces, "_BATCH_SIGNS", 200)
    tokens = tokenfiles.ChunkTokens(byte_tokenizer_path())
    asked = []
    tokenize = tokens.chunks.tokenize
    tokens.chunks.tokenize = lambda chunks: asked.append(chunks) or tokenize(chunks)
    texts = [t or "" for t in TEXTS] * 3
    expected = [np.array(plain(tokenizer, t)[:-1], tokens.width).tobytes() for t in texts]
    assert tokens.encode(texts) == expected
    assert asked and all(len(set(chunks)) == len(chunks) for chunks in asked)
    assert len(tokens.chunks.rows) <= 8
