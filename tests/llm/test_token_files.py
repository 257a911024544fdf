"""Token files: what is read back equals what the tokenizer gives, document by document."""

import glob
import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from frames import frame, odd_rows  # noqa: F401
from pyarrow import fs as arrow_fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from realmwatch.llm.queries import QUERIES
from realmwatch.llm.token_files import TokenFile, TokenFileWriter, train_dictionary, write_token_files

SF_DIR = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def plain(tokenizer, rows, end_id=2):
    """(doc_id, start, n_tokens, crc, ids) in ascending order of ids, those without one first."""
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_query_equals_the_tokenizer(spark, tokenizer):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_token_files"](spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == [r[:4] for r in plain(tokenizer, rows)]


def test_files_and_single_documents(spark, tokenizer, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    written = write_token_files(docs, VOCABULARY, str(tmp_path / "out"), partitions=4, file_bytes=20_000, sample_chars=4000)
    expected = plain(tokenizer, rows)
    files = written.files().orderBy("start").collect()
    assert len(files) > 8 and files == sorted(files, key=lambda r: (r.part, r.number))
    assert sum(r.tokens for r in files) == sum(r[2] for r in expected)
    assert [r.start for r in files] == list(np.cumsum([0] + [r.tokens for r in files[:-1]]))
    on_disk = glob.glob(str(tmp_path / "out" / "tokens-*.bin"))
    assert sorted(map(os.path.basename, on_disk)) == sorted(r.file for r in files)
    assert {os.path.basename(p): os.path.getsize(p) for p in on_disk} == {r.file: r.size for r in files}
    assert len(written.dictionary()) > 1000
    for i, _, _, _, ids in expected[::37]:
        assert [d.tolist() for d in written.document(i)] == [ids]
    assert written.document(-5) == []
    wanted = spark.createDataFrame([(rows[3][0],), (rows[9][0],)], "doc_id long")
    picked = {r.doc_id: (r.start, r.ids) for r in written.token_ids(wanted).collect()}
    assert picked == {r[0]: (r[1], r[4]) for r in expected if r[0] in (rows[3][0], rows[9][0])}
    # a file that no table lists does not count
    (tmp_path / "out" / "tokens-000000-0000-left.bin").write_bytes(b"half a file")
    assert written.documents().count() == len(rows)


def test_the_dictionary_makes_short_documents_small(tmp_path, tokenizer):
    texts = [f"The minutes of meeting number {k} were read and approved by the board of directors." for k in range(400)]
    arrays = [np.array(e.ids, "<u2") for e in tokenizer.encode_batch(texts)]
    dictionary = train_dictionary([a.tobytes() for a in arrays[:300]], 4096)
    sizes = []
    for name, used in (("with", dictionary), ("without", b"")):
        local = arrow_fs.LocalFileSystem()
        writer = TokenFileWriter(local, str(tmp_path / name), used, np.dtype("<u2"), 3)
        for k, a in enumerate(arrays[300:]):
            writer.add(k, a)
        writer.close()
        opened = TokenFile(local, str(tmp_path / name), used)
        assert all((opened.ids(opened.entry(k)) == a).all() for k, a in enumerate(arrays[300:]))
        sizes.append(writer.size)
    assert sizes[0] < 0.75 * sizes[1]
    with pytest.raises(ValueError, match="another dictionary"):
        TokenFile(local, str(tmp_path / "with"), b"")
    (tmp_path / "cut").write_bytes((tmp_path / "with").read_bytes()[:-30])
    with pytest.raises(ValueError, match="whole"):
        TokenFile(local, str(tmp_path / "cut"), dictionary)


def test_odd_rows(spark, frame, odd_rows, tokenizer):  # noqa: F811
    odd = [*odd_rows, (8, "x <|endoftext|> y", "c"), (5, "one of its ids", "a"), (None, None, None)]
    docs = frame(odd)
    for name in ("id", "salt", "part", "file", "start", "n_tokens"):
        docs = docs.withColumn(name, F.lit("clash"))
    written = write_token_files(docs, VOCABULARY, partitions=3, file_bytes=1000)
    got = written.documents().orderBy("start").collect()
    expected = plain(tokenizer, [(i, t) for i, t, _ in odd])
    # documents of one id may stand in another order among themselves
    assert [r.doc_id for r in got] == [r[0] for r in expected]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((r[0], *r[2:4]) for r in expected)
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got[:-1]]))
    assert sorted(len(d) for d in written.document(5)) == sorted(r[2] for r in expected if r[0] == 5)
    empty = write_token_files(frame([]), VOCABULARY)
    assert empty.documents().count() == 0 and empty.document(1) == [] and empty.dictionary() == b""


def test_rows_of_one_id_span_files(spark, tokenizer):
    docs = spark.range(900).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same text in all rows").alias("text"))
    written = write_token_files(docs, VOCABULARY, partitions=4)
    assert written.files().count() == 4
    got = written.documents().collect()
    size = len(tokenizer.encode("the same text in all rows").ids) + 1
    assert sorted(r.start for r in got) == [k * size for k in range(900)] and len(written.document(7)) == 900
