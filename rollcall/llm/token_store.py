"""Token ids in Parquet: list columns in order of doc_id, in files that can be read in part.

Documents are dealt to ranges of doc_id and encoded where they are written, so
texts are shuffled once and ids never. A file holds one range: doc_id, the
number of ids before the document in this file, its number of ids, and the ids
as a list column. Ids are dictionary or delta encoded in row groups and pages of
set sizes, with page indexes, and the numbers beside them in delta encoding.
A small index beside the files holds, for each of them, its documents, its ids and
how many come before it, so metadata is read without ids and a range of ids
without the rest.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollcall.llm.support import Scratch, by_value, joined_small, table

by_value(__name__)

VOCABULARY = "byte_bpe_50k.json"
END = 0
# Bytes of text of a file, of ids of a row group and of a page, and rows of a page.
FILE_BYTES, GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 1 << 26, 1 << 24, 1 << 17, 512
# Texts encoded by one call of the tokenizer, at most this many characters unless one text is longer.
CALL_CHARS = 1 << 20
CUT = re.compile(r"(?= \S)")
# Pieces remembered by a worker, and those of them that stay when there are too many: the ones met most often.
MOST_PIECES, KEPT_PIECES = 250_000, 125_000
# Lines of one word of Latin letters and the marks that may follow it: words and marks are words of the splitting pattern.
MARKS = ".,;:!?"
LETTERS = r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+"
PLAIN = re.compile(rf"( ?)({LETTERS})([.,;:!?]*)((?:\n{LETTERS}[.,;:!?]*)*)")
# Files of one block of the index, whose totals are summed first.
BLOCK = 1024
STORED = "doc_id bigint, start bigint, n_tokens bigint, ids array<int>"


class Numbers(dict):
    """Numbers words in the order they are first met; ``fresh`` holds the new ones."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class Encoder:
    """A tokenizer that remembers the ids of the pieces of texts it has met.

    Texts are cut before each space that a visible character follows. With
    byte-level splitting the ids of a text are those of its pieces: no word of the
    pattern holds a space but at its start, and a run of white space leaves its last
    space to the word behind it. A tokenizer of another kind encodes whole texts.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.pieces = by_pieces(json.loads(vocabulary))
        self.forget()

    def forget(self) -> None:
        self.numbers, self.ids, self.starts, self.sizes, self.words = Numbers(), array("i"), array("q"), array("q"), {}
        self.uses = np.zeros(0, np.int64)
        # Pieces that only a careless cut gives: empty, or with white space behind the space they were cut at.
        self.unsure: set[int] = set()

    def thin(self) -> None:
        """Forget the pieces met least often, and those met once."""
        often = np.argsort(-self.uses, kind="stable")[:KEPT_PIECES]
        kept = np.sort(often[self.uses[often] > 1])
        keys, unsure, uses = np.array(list(self.numbers), object)[kept].tolist(), self.unsure, self.uses[kept]
        table, sizes = np.frombuffer(self.ids, np.int32), np.frombuffer(self.sizes, np.int64)[kept]
        ends = np.cumsum(sizes)
        ids = table[np.repeat(np.frombuffer(self.starts, np.int64)[kept] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        self.forget()
        self.numbers.update(zip(keys, range(len(keys)), strict=True))
        self.ids, self.starts, self.sizes = array("i", ids.tobytes()), array("q", (ends - sizes).tobytes()), array("q", sizes.tobytes())
        # What was met often long ago goes some day.
        self.uses = uses // 2
        self.unsure = set(np.flatnonzero(np.isin(kept, list(unsure))).tolist())

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after the other, and the number of each text's ids."""
        if len(self.numbers) > MOST_PIECES:
            self.thin()
        which, counts = self.number(texts, np.zeros(len(texts), bool))
        if self.unsure:
            odd = np.isin(which, list(self.unsure))
            if odd.any():
                again = np.add.reduceat(odd, np.cumsum(counts) - counts) > 0
                which, counts = self.number(texts, again)
        uses = np.bincount(which, minlength=len(self.numbers))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        table, starts = np.frombuffer(self.ids, np.int32), np.frombuffer(self.starts, np.int64)
        sizes = np.frombuffer(self.sizes, np.int64)[which]
        ends = np.cumsum(sizes)
        ids = table[np.repeat(starts[which] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        return ids, np.diff(np.append(0, ends)[np.append(0, np.cumsum(counts))])

    def number(self, texts: list[str], careful: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all pieces of the texts, and how many each text has."""
        keys: list[str] = []
        counts = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            mine = keys_of(text, careful[i]) if self.pieces else [" " + text]
            counts[i] = len(mine)
            keys += mine
        which = np.fromiter(map(self.numbers.__getitem__, keys), np.int64, len(keys))
        self.learn()
        return which, counts

    def learn(self) -> None:
        """Find the ids of the new pieces: of plain words from the model, of others from the whole tokenizer."""
        fresh, self.numbers.fresh = self.numbers.fresh, []
        ids, others, known, word_ids = self.ids, [], self.words.get, self.word
        extend, start, size, plain = ids.extend, self.starts.append, self.sizes.append, PLAIN.fullmatch
        for i, key in enumerate(fresh, len(self.starts)):
            at = len(ids)
            match = plain(key) if self.pieces else None
            if match is None:
                others.append(i)
                if not key or (key[0] != " " and key[0].isspace()):
                    self.unsure.add(i)
            else:
                lead, word, marks, more = match.groups()
                name = word if word.isascii() else byte_letters(word)
                name = name if lead else "\u0120" + name
                extend(known(name) or word_ids(name))
                if marks:
                    extend(known(marks) or word_ids(marks))
                if more:
                    for line in more.split("\n")[1:]:
                        word = line.rstrip(MARKS)
                        extend(word_ids("\u010a"))
                        extend(word_ids(word if word.isascii() else byte_letters(word)))
                        if len(word) < len(line):
                            extend(word_ids(line[len(word) :]))
            start(at)
            size(len(ids) - at)
        if others:
            first = len(self.starts) - len(fresh)
            keys = [fresh[i - first] for i in others]
            # A key that begins with a space is a text's first piece, without that space.
            whole = [key[1:] if key[:1] == " " else " " + key for key in keys]
            for i, found in zip(others, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False), strict=True):
                self.starts[i], self.sizes[i] = len(ids), len(found)
                ids.extend(found.ids)

    def word(self, letters: str) -> array:
        """Ids of one word of the splitting pattern, in byte letters."""
        ids = self.words.get(letters)
        if ids is None:
            ids = self.words[letters] = array("i", [t.id for t in self.model.tokenize(letters)])
        return ids


def byte_letters(word: str) -> str:
    """The word's bytes, each as the letter that stands for it; letters of Latin-1 have bytes from 0x80 on."""
    return "".join(chr(b) if b < 0x80 or 0xA1 <= b != 0xAD else chr(0x122 + b - 0x80 if b <= 0xA0 else 0x143) for b in word.encode())


def keys_of(text: str, careful: bool) -> list[str]:
    """The pieces of a text: the first behind an added space, all others without their space.

    Unless careful, it is cut at every space, which is the same for texts whose spaces stand alone.
    """
    words = text.split(" ")
    if careful:
        words = CUT.split(text)
        words[1:] = [w[1:] for w in words[1:]]
    words[0] = " " + words[0]
    return words


_encoders: dict = {}


def loaded(vocabulary: str) -> Encoder:
    """The encoder of a vocabulary, made once per worker."""
    if _encoders.get("text") is not vocabulary:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders.update(text=vocabulary, made=Encoder(vocabulary))
    return _encoders["made"]


def by_pieces(model: dict) -> bool:
    """Whether a tokenizer splits texts at byte level and every added token holds something besides letters, marks and spaces."""
    split = model.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
    added = model.get("added_tokens") or []
    alone = all(
        re.search(r"[^\w\s.,;:!?]", t["content"]) and not re.search(r"\s", t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"])
        for t in added
    )
    return bool(plain and alone and model.get("normalizer") is None and model["model"]["type"] == "BPE")


def calls(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows for one call each: as many as hold at most ``most`` in all, and at least one."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and held + size > most:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def encoded(batches: Iterator[pa.RecordBatch], vocabulary: str, end: int) -> Iterator[pa.RecordBatch]:
    """Rows to store from (doc_id, text) in order; ``start`` runs through the partition."""
    encoder, before = loaded(vocabulary), 0
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for a, b in calls([len(t) for t in texts], CALL_CHARS):
            ids, counts = encoder.texts(texts[a:b])
            ids, counts = np.insert(ids, np.cumsum(counts), np.int32(end)), counts + 1
            ends = np.cumsum(counts)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids))
            starts = before + ends - counts
            before += int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(starts), pa.array(counts), lists], names=["doc_id", "start", "n_tokens", "ids"]
            )


def options(delta: bool, group_bytes: int, page_bytes: int, page_rows: int) -> dict[str, str]:
    """Writer settings: with the second page version, numbers without a dictionary are delta encoded."""
    return {
        "parquet.writer.version": "v2",
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#ids.list.element": str(not delta).lower(),
        "parquet.dictionary.page.size": str(1 << 20),
        "parquet.block.size": str(group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "compression": "zstd",
        "parquet.compression.codec.zstd.level": "1",
    }


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end: int = END,
    delta: bool = False,
    file_bytes: int = FILE_BYTES,
    group_bytes: int = GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Write the ids of ``docs`` below ``path``: files in ``ids``, their index in ``index``.

    Documents are in ascending order of doc_id, rows without one first; rows
    that share a doc_id are ordered by a hash of their text, and a doc_id may
    span files. NULL text is empty and has the end id alone. No rows make an empty
    store. Columns besides doc_id and text are not kept.
    """
    bare = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = bare.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    keyed = bare.withColumn("tie", F.xxhash64("text"))
    ranges = keyed.repartitionByRange(max(1, -(-total // file_bytes)), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = ranges.select("doc_id", "text").mapInArrow(lambda it: encoded(it, shared.value, end), STORED)
    # Files are in ascending order of their ranges' numbers, which Spark puts into their names.
    rows.write.options(**options(delta, group_bytes, page_bytes, page_rows)).parquet(f"{path}/ids")
    meta = docs.sparkSession.read.schema(STORED).parquet(f"{path}/ids").select("doc_id", "n_tokens", F.col("_metadata.file_name").alias("file"))
    files = meta.groupBy("file").agg(
        F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"),
        F.count("*").alias("n_docs"),
        F.sum("n_tokens").alias("n_tokens"),
        F.count_if(F.col("doc_id").isNull()).alias("n_null"),
    )
    numbered(files).write.parquet(f"{path}/index")


def numbered(files: DataFrame) -> DataFrame:
    """The index with ``before``: ids of all files before one, by blocks so that no window spans all files."""
    number = F.regexp_extract("file", "part-([0-9]+)", 1).cast("bigint")
    files = files.withColumns({"number": number, "block": F.expr(f"CAST(regexp_extract(file, 'part-([0-9]+)', 1) AS BIGINT) DIV {BLOCK}")})
    blocks = files.groupBy("block").agg(F.sum("n_tokens").alias("t"))
    # One row per BLOCK files.
    earlier = F.sum("t").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("block", F.coalesce(earlier, F.lit(0)).alias("shift"))
    # A range with more rows than a file may hold spans files of one number, whose names go on ascending.
    inner = Window.partitionBy("block").orderBy("number", "file").rowsBetween(Window.unboundedPreceding, -1)
    here = files.withColumn("within", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
    first = F.first("within").over(Window.partitionBy("block", "number").orderBy("file"))
    out = here.withColumn("base", first).join(blocks, "block")
    return out.select(
        "file", "number", "first_doc", "last_doc", "n_docs", "n_null", "n_tokens",
        (F.col("base") + F.col("shift")).alias("before"),
        (F.col("within") + F.col("shift")).alias("first_token"),
    )


def index(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: file, number, first_doc, last_doc, n_docs, n_null, n_tokens, before (the shift of its starts), first_token."""
    return spark.read.parquet(f"{path}/index")


def stored(spark: SparkSession, path: str, files: list[str] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids, file; ids are read only if they are used."""
    places = [f"{path}/ids/{f}" for f in files] if files is not None else [f"{path}/ids"]
    rows = spark.read.schema(STORED).parquet(*places).select("*", F.col("_metadata.file_name").alias("file"))
    shifts = index(spark, path).select("file", "before")
    return joined_small(rows, shifts, "file", "inner").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids", "file"
    )


def documents(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """The documents with doc_id from ``first`` to ``last``: only files, row groups and pages that may hold them are read."""
    files = [r["file"] for r in index(spark, path).where((F.col("last_doc") >= first) & (F.col("first_doc") <= last)).select("file").collect()]
    return stored(spark, path, files).where(F.col("doc_id").between(first, last)) if files else stored(spark, path).limit(0)


def tokens(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """(doc_id, at, ids): the ids from place ``first`` to before ``last`` of the whole sequence, cut at both ends."""
    wanted = (F.col("first_token") < last) & (F.col("first_token") + F.col("n_tokens") > first)
    parts = index(spark, path).where(wanted).select("file", "before").collect()
    found = None
    for shift, files in sorted({r["before"]: [x["file"] for x in parts if x["before"] == r["before"]] for r in parts}.items()):
        rows = spark.read.schema(STORED).parquet(*[f"{path}/ids/{f}" for f in files])
        # Starts ascend in a file, so the condition on them prunes row groups and pages.
        rows = rows.where((F.col("start") < last - shift) & (F.col("start") + F.col("n_tokens") > first - shift))
        begin = F.greatest(F.lit(first - shift) - F.col("start"), F.lit(0))
        end = F.least(F.lit(last - shift) - F.col("start"), F.col("n_tokens"))
        cut = F.slice("ids", (begin + 1).cast("int"), (end - begin).cast("int"))
        part = rows.select("doc_id", (F.col("start") + shift + begin).alias("at"), cut.alias("ids"))
        found = part if found is None else found.union(part)
    return found if found is not None else spark.createDataFrame([], "doc_id bigint, at bigint, ids array<int>")


def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, start, n_tokens and the CRC-32 of the ids as little-endian 32-bit integers."""
    for batch in batches:
        lists = batch.column(3)
        flat, ends = np.asarray(lists.flatten(), dtype="<i4"), np.cumsum(np.asarray(batch.column(2)))
        crcs = [zlib.crc32(flat[b - n : b].tobytes()) for b, n in zip(ends.tolist(), batch.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document, read back from the files."""
    rows = stored(spark, path).select("doc_id", "start", "n_tokens", "ids")
    return rows.mapInArrow(sums, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op11_token_store(spark: SparkSession, directory: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    with open(vocabulary, encoding="utf-8") as f:
        text = f.read()
    path = f"{Scratch(spark, 'token_store').root}/store"
    write(table(spark, directory, "documents"), path, text)
    return checksums(spark, path)
