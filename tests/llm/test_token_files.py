import zlib

import numpy as np
import odd
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_files
from tidemark.llm.bpe import default_vocabulary

VOCABULARY = default_vocabulary()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def test_query_matches_the_library(spark, sf, library):
    found = {r["doc_id"]: r for r in token_files.op10_token_files(spark, sf).collect()}
    start = 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        row = found.pop(r["doc_id"])
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not found


def test_odd_rows_and_lookup(spark, path, library, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_BYTES", 4096)
    token_files.write(spark, odd.table(spark), path, "doc_id", "text", VOCABULARY)
    rows = sorted(((r[0] is not None, r[0] or 0, r[1] or "") for r in odd.rows()))
    found = token_files.read(spark, path).orderBy("start").collect()
    start = 0
    for (has, key, text), r in zip(rows, found, strict=True):
        want = library.encode(text, add_special_tokens=False).ids + [0]
        assert r["key"] == (key if has else None) and r["start"] == start
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        start += len(want)
    some = token_files.lookup(spark, path, [2, 9, 77]).collect()
    assert sorted(r["key"] for r in some) == [2, 2, 9]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in some if r["key"] == 9] == [library.encode("one two").ids + [0]]


def test_empty_table_and_wrong_dictionary(spark, path):
    token_files.write(spark, odd.empty(spark), path, "doc_id", "text", VOCABULARY)
    assert token_files.read(spark, path).count() == 0
    data = token_files.pack([(1, np.array([3, 0]))], [b""], b"0" * 32, 2)
    with pytest.raises(ValueError, match="dictionary"):
        token_files.Segment(data, b"other")


@pytest.mark.parametrize("text", ["x" * 5000, "ab" * 4000 + " <|endoftext|> c", "é" * 3000, "plain <|endoftext|>", "", "\x85 \x1c a"])
def test_encoder_gives_the_ids_of_the_library(library, text):
    table, special = token_files.ranks(VOCABULARY)
    encode = token_files.encoder(table, special, open(VOCABULARY, encoding="utf-8").read())
    assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
