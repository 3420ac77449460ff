"""Token files: order, contents, encodings, selective reads."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rollcall.llm import token_store

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(token_store.VOCABULARY)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def rows_of(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


def brute(tokenizer, docs):
    out, start = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = np.array(ids_of(tokenizer, text), dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_the_small_table_equals_the_tokenizer(spark, tokenizer):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = token_store.op11_token_store(spark, SMALL)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 4
    assert rows_of(got) == brute(tokenizer, docs)


@pytest.mark.parametrize("delta", [False, True])
def test_files_and_selective_reads(spark, tokenizer, vocabulary, tmp_path, documents, delta):
    words = ["the", "of", "é", "naïve", "\n", "<|endoftext|>", "1234", "日本"]
    docs = [(i * 7, " ".join(words[(i + k) % 8] for k in range(i % 23))) for i in range(400)] + [(14, None), (21, ""), (-3, "x" * 30_000)]
    path = str(tmp_path / "store")
    token_store.write(documents(docs), path, vocabulary, delta=delta, file_bytes=8_000, group_bytes=4_000, page_bytes=1_000, page_rows=16)
    whole = brute(tokenizer, docs)
    got = rows_of(token_store.checksums(spark, path))
    assert [r[1:3] for r in got if r[0] not in (14, 21)] == [r[1:3] for r in whole if r[0] not in (14, 21)]
    assert sorted((r[0] or 0, r[2], r[3]) for r in got) == sorted((r[0] or 0, r[2], r[3]) for r in whole)
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got]).tolist()[:-1]]

    listed = token_store.index(spark, path).orderBy("file").collect()
    assert len(listed) > 3 and [r.first_token for r in listed] == [0, *np.cumsum([r.n_tokens for r in listed]).tolist()[:-1]]
    order = []
    for r in listed:
        file = pq.ParquetFile(f"{path}/ids/{r.file}")
        order += file.read(columns=["doc_id"])["doc_id"].to_pylist()
        for g in range(file.metadata.num_row_groups):
            columns = {file.metadata.row_group(g).column(c).path_in_schema: file.metadata.row_group(g).column(c) for c in range(4)}
            coded = set(columns["ids.list.element"].encodings)
            assert ("DELTA_BINARY_PACKED" in coded) if delta else ("RLE_DICTIONARY" in coded)
            assert "DELTA_BINARY_PACKED" in columns["start"].encodings
            assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    assert order == sorted(order) and len(order) == len(docs)

    meta = token_store.stored(spark, path).agg(F.sum("n_tokens"), F.max("start"))
    assert "ids" not in meta._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].splitlines()[0]
    assert meta.first()[0] == sum(r[2] for r in whole)
    some = token_store.documents(spark, path, 700, 777).orderBy("doc_id").collect()
    by_id = dict(docs)
    assert [r.doc_id for r in some] == list(range(700, 778, 7)) and all(r.ids == ids_of(tokenizer, by_id[r.doc_id]) for r in some)
    stream = [x for r in sorted(token_store.stored(spark, path).collect(), key=lambda r: r.start) for x in r.ids]
    for first, last in ((0, 10), (95, 1200), (len(stream) - 3, len(stream) + 50), (5, 5)):
        parts = sorted(token_store.tokens(spark, path, first, last).collect(), key=lambda r: r.at)
        assert [x for r in parts for x in r.ids] == stream[first:last]
        assert not parts or parts[0]["at"] == first
    assert token_store.documents(spark, path, 10**9, 10**9 + 5).count() == 0


def test_missing_ids_and_no_rows(spark, tokenizer, vocabulary, tmp_path, documents):
    docs = [(None, "b"), (None, "a"), (5, "c"), (5, "c")]
    path = str(tmp_path / "ties")
    token_store.write(documents(docs), path, vocabulary)
    got = rows_of(token_store.checksums(spark, path))
    assert [r[0] for r in got] == [None, None, 5, 5] and sorted(r[3] for r in got) == sorted(r[3] for r in brute(tokenizer, docs))
    empty = str(tmp_path / "empty")
    token_store.write(documents([(1, "a")]).limit(0), empty, vocabulary)
    assert token_store.checksums(spark, empty).count() == 0 and token_store.tokens(spark, empty, 0, 5).count() == 0


def test_pieces_met_often_stay_when_others_are_forgotten(tokenizer, vocabulary, monkeypatch):
    monkeypatch.setattr(token_store, "MOST_PIECES", 60)
    monkeypatch.setattr(token_store, "KEPT_PIECES", 20)
    encoder = token_store.Encoder(vocabulary)
    for n in range(30):
        texts = [f"The naïve one, the  new\n\nword{chr(97 + n % 26)}{'xyz'[n % 3]} and  \t{n * 7919}.\nend" for _ in range(3)]
        texts += ["", " ", "the and the and", " ".join(f"q{n}w{k}" for k in range(40))]
        ids, counts = encoder.texts(texts)
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
        if n:
            # Among the few pieces kept, though the ones of this call alone are more than those.
            assert {"the", "and"} <= set(list(encoder.numbers)[:20]) and len(encoder.numbers) < 130
    encoder.forget()
    once = [" ".join(f"z{k}" for k in range(100))]
    assert all(encoder.texts(once)[0].tolist() == tokenizer.encode(once[0], add_special_tokens=False).ids for _ in range(4))
