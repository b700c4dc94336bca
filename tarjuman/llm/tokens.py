"""Token-ID output: documents as token ids in a compressed file format, and back.

Files below a folder: ``table`` holds the shared frequency table (id, count) and
``blocks`` one row per block: ``part`` and ``block`` (order), ``offset`` (ids of the
part before it), ids and lengths of its documents, and a payload of ``rans``. Parts are
ranges of (doc_id, fingerprint of the text), so files and blocks ascend by doc_id. A
block holds whole documents, about ``BLOCK`` ids; a longer document is cut into pieces.
Blocks decode independently of each other.

Texts are encoded once, in order; the ids are kept as a table between counting and
coding, so that the frequency table covers all ids.

Defined cases: a null text is an empty one and gives the end id alone; rows without an
id come first; rows of one id follow one another by fingerprint, then text; repeated
rows are written as often as they occur; an empty table gives no blocks; other columns
are not written.
"""

import json
import os
import re
import string
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tarjuman.llm import rans
from tarjuman.llm.common import small_batches
from tarjuman.workspace import new_folder

BLOCK = 1 << 16
BLOCKS_AT_ONCE = 32
END_ID = 0
#: Words of letters, and other pieces, that are remembered at least, if they are no longer than this.
MOST_WORDS, MOST_OTHERS, LONGEST = 600_000, 100_000, 64
#: Characters of the texts that are encoded together.
TOGETHER = 1 << 21
MARKS = string.punctuation
#: What a blank is in the vocabulary of a byte-level tokenizer.
BLANK = "\u0120"
#: The first character whose class is left to the library.
BEYOND = "\u0250"

#: What splits text before the merges of a byte-level BPE vocabulary.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A blank between other characters starts a pre-token; blanks beside white space may not.
SINGLE = re.compile(r"(?<=\S) (?=\S)")
#: Arrow's pattern of a text with a blank that may be at an end or beside white space.
UNEVEN = "^ | $|  | \n|\n |[\t\r\x0b\x0c\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Arrow's pattern of what libraries may or may not take for white space.
ODD = "[\x1c-\x1f\x85\u180e\u200b-\u200d\u2060\ufeff]"


class Encoder:
    """A tokenizer file's ids for texts, remembering the words it has seen.

    With byte-level BPE, a piece between single blanks is encoded alike in any text, so
    each distinct piece goes through the library once: its own pre-tokens straight to
    the model if all its characters are below U+0250, else as a small text. Arrow splits
    many texts at once and finds their distinct pieces, which are looked up once for all.
    Texts with added tokens or odd white space, and other kinds of tokenizers, are
    encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        layout = json.loads(self.tokenizer.to_str())
        pre = layout["pre_tokenizer"] or {}
        self.by_piece = (
            layout["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and layout["model"]["type"] == "BPE"
            and not layout["model"].get("dropout")
        )
        self.whole = "|".join([ODD, *(re.escape(t["content"]) for t in layout["added_tokens"])])
        self.words = Remembered(self._letters, MOST_WORDS)
        self.mixed, self.other = Remembered(self._mixed, MOST_OTHERS), Remembered(self._word, MOST_OTHERS)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.bytes = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.tokenize = self.tokenizer.model.tokenize

    def _text(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of one pre-token."""
        return self._model(word.encode().decode("latin-1").translate(self.bytes))

    def _model(self, mapped: str) -> bytes:
        return array("I", [token.id for token in self.tokenize(mapped)]).tobytes()

    def _letters(self, word: str) -> bytes:
        """The ids of a blank and ``word``, which has only letters."""
        if word.isascii():
            return self._model(BLANK + word)
        return self._word(" " + word) if max(word) < BEYOND else self._text(" " + word)

    def _mixed(self, piece: str) -> bytes:
        """The ids of a blank and ``piece``, which has no single blank in it."""
        if not piece.isascii() and max(piece) >= BEYOND:
            return self._text(" " + piece)
        # Most are letters with marks at the end, or end one line and begin another.
        line, end, rest = piece.partition("\n")
        word = line.rstrip(MARKS)
        if word.isalpha() and (not end or rest.isalpha()):
            others = [part for part in (line[len(word):], end, rest) if part]
            return self.words[word] + b"".join([self.other[part] for part in others])
        return self._parts(" " + piece)

    def _parts(self, piece: str) -> bytes:
        if not piece.isascii() and max(piece) >= BEYOND:
            return self._text(piece)
        return b"".join([
            self.words[part[1:]] if part[0] == " " and part[1:].isalpha() else self.other[part]
            for part in WORDS.findall(piece)
        ])

    def _split(self, texts: pa.ListArray) -> list[np.ndarray]:
        """The ids of texts that are given as their pieces, at least one each."""
        bounds = texts.offsets.to_numpy()
        pieces = texts.flatten()
        # No blank belongs to a text's first piece.
        first = np.zeros(len(pieces), bool)
        first[bounds[:-1]] = True
        coded = pieces.filter(pa.array(~first)).dictionary_encode()
        words, mixed = self.words, self.mixed
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = [words[piece] if piece.isalpha() else mixed[piece] for piece in distinct]
        which = np.empty(len(pieces), np.int64)
        which[~first] = coded.indices.to_numpy()
        which[first] = np.arange(len(found), len(found) + len(texts))
        found += map(self._parts, pieces.filter(pa.array(first)).to_numpy(zero_copy_only=False))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        n = sizes[which]
        ends = np.cumsum(n)
        at = np.repeat(starts[which] - (ends - n), n)
        at += np.arange(len(at))
        ids = np.frombuffer(b"".join(found), "<u4")[at]
        return np.split(ids, ends[bounds[1:-1] - 1])

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        column = pa.array(texts, pa.large_string())
        whole = pc.match_substring_regex(column, self.whole).to_numpy(zero_copy_only=False)
        whole |= pc.equal(column, "").to_numpy(zero_copy_only=False) | (not self.by_piece)
        uneven = pc.match_substring_regex(column, UNEVEN).to_numpy(zero_copy_only=False) & ~whole
        even = ~whole & ~uneven
        coded: list = [None] * len(texts)
        for i in np.flatnonzero(whole):
            coded[i] = np.frombuffer(self._text(texts[i]), "<u4")
        if uneven.any():
            places = np.flatnonzero(uneven)
            split = pa.array([SINGLE.split(texts[i]) for i in places], pa.large_list(pa.large_string()))
            for i, ids in zip(places, self._split(split)):
                coded[i] = ids
        if even.any():
            split = pc.split_pattern(column if even.all() else column.filter(pa.array(even)), " ")
            for i, ids in zip(np.flatnonzero(even), self._split(split)):
                coded[i] = ids
        return coded

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0].tobytes()


class Remembered(dict):
    """Results of ``compute`` by argument, those of the last ``most`` or more short arguments.

    A full dictionary becomes the old one, which is looked into once more before it goes.
    """

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) > LONGEST:
            return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_texts(docs: DataFrame, path: str, doc_id: str, text: str) -> DataFrame:
    """``(part, seq, offset, doc_id, n, ids)`` in ascending order of doc_id within and over parts,
    and a row per task with ``used`` ids and their ``counts``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    # Few bytes in a row make a range partition of many rows; long texts are spread by their own key.
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    kind = docs.schema[doc_id].dataType.simpleString()

    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[list[pd.DataFrame]]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += sum(map(len, batch["text"]))
            if size >= TOGETHER:
                yield held
                held, size = [], 0
        if held:
            yield held

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, offset = TaskContext.get().partitionId(), 0, 0
        total = np.zeros(0, np.int64)
        known = encoder(path)
        end = np.array([END_ID], "<u4")
        for held in gathered(batches):
            together = iter(known.encode_all([text for batch in held for text in batch["text"]]))
            for batch in held:
                coded = [np.concatenate((ids, end)) for ids in islice(together, len(batch))]
                n = np.array([len(ids) for ids in coded], np.int64)
                own = np.bincount(np.concatenate(coded)) if coded else total[:0]
                if len(own) > len(total):
                    own, total = total, own
                total[:len(own)] += own
                yield pd.DataFrame({
                    "part": part, "seq": np.arange(seq, seq + len(n)), "offset": offset + np.cumsum(n) - n,
                    "doc_id": batch["doc_id"], "n": n, "ids": [ids.astype("<u2").tobytes() if ids.max() < 1 << 16
                                                               else ids.tobytes() for ids in coded],
                    "used": None, "counts": None,
                })
                seq, offset = seq + len(n), offset + int(n.sum())
        used = np.flatnonzero(total)
        yield pd.DataFrame({
            "part": [part], "seq": -1, "offset": -1, "doc_id": None, "n": 0, "ids": None,
            "used": [used], "counts": [total[used]],
        })

    return ordered.mapInPandas(
        encode, f"part int, seq long, offset long, doc_id {kind}, n long, ids binary, used array<long>, counts array<long>")


def ids_of(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype(np.uint32)


def count_ids(coded: DataFrame) -> DataFrame:
    """``(id, count)`` over all texts, from one row per task of the encoding."""
    counted = coded.where("used is not null").select(F.explode(F.arrays_zip("used", "counts")).alias("c"))
    return counted.groupBy(F.col("c.used").alias("id")).agg(F.sum("c.counts").alias("count"))


def shared_table(spark: SparkSession, folder: str):
    """The frequency table, as many rows as the vocabulary has ids."""
    rows = spark.read.schema("id long, count long").parquet(f"{folder}/table").toPandas()
    return spark.sparkContext.broadcast((rows["id"].to_numpy(), rows["count"].to_numpy()))


def write_tokens(
    docs: DataFrame, folder: str, path: str, doc_id: str = "doc_id", text: str = "text",
    block_ids: int = BLOCK,
) -> None:
    """Encode ``docs`` and write them below ``folder``, in blocks of about ``block_ids`` ids."""
    spark = docs.sparkSession
    between = new_folder(spark, "token-ids")
    coded = encode_texts(docs, path, doc_id, text)
    coded.write.option("compression", "zstd").parquet(between)
    coded = spark.read.schema(coded.schema).parquet(between)
    count_ids(coded).write.parquet(f"{folder}/table")
    shared = shared_table(spark, folder)
    coded = coded.where("used is null").drop("used", "counts")
    kind, names = coded.schema["doc_id"].dataType.simpleString(), coded.columns

    def blocks_of(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
        """Documents in order, gathered to blocks; a gap in the order starts a new one."""
        block: dict | None = None
        for batch in batches:
            for part, seq, offset, own, n, data in zip(*(batch[c] for c in names)):
                ids = ids_of(data, n)
                own = None if pd.isna(own) else own
                for piece, at in enumerate(range(0, len(ids), block_ids)):
                    follows = (block and len(ids) <= block_ids and block["part"] == part
                               and block["next"] == seq)
                    if block and not (follows and block["size"] < block_ids and block["whole"]):
                        yield block
                        block = None
                    if not block:
                        block = {"part": part, "block": seq, "piece": piece, "offset": offset + at,
                                 "whole": len(ids) <= block_ids, "size": 0, "docs": [], "lengths": [], "ids": []}
                    block["next"] = seq + 1
                    block["docs"].append(own)
                    block["lengths"].append(len(ids[at:at + block_ids]))
                    block["ids"].append(ids[at:at + block_ids])
                    block["size"] += len(ids[at:at + block_ids])
        if block:
            yield block

    columns = ["part", "block", "piece", "whole", "offset", "size", "docs", "lengths"]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = rans.Table(*shared.value)
        held: list[dict] = []

        def flush() -> pd.DataFrame:
            payloads = rans.encode([np.concatenate(b["ids"]) for b in held], table)
            return pd.DataFrame([{c: b[c] for c in columns} | {"payload": p} for b, p in zip(held, payloads)])

        for block in blocks_of(batches):
            held.append(block)
            if len(held) == BLOCKS_AT_ONCE:
                yield flush()
                held = []
        if held:
            yield flush()

    packed = coded.mapInPandas(
        pack, "part int, block long, piece int, whole boolean, offset long, size long, "
        f"docs array<{kind}>, lengths array<long>, payload binary",
    )
    packed.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def crc_shift(crc: int, length: int) -> int:
    """The crc32 register ``crc`` after ``length`` zero bytes, by squaring the shift."""
    def times(matrix: list[int], vector: int) -> int:
        result, row = 0, 0
        while vector:
            if vector & 1:
                result ^= matrix[row]
            vector, row = vector >> 1, row + 1
        return result

    matrix = [0xEDB88320] + [1 << i for i in range(31)]
    bits = 8 * length
    while bits:
        if bits & 1:
            crc = times(matrix, crc)
        matrix = [times(matrix, row) for row in matrix]
        bits >>= 1
    return crc


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, decoded from the files."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCKS_AT_ONCE))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16MB")
    shared = shared_table(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["docs"].dataType.elementType.simpleString()

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = rans.Table(*shared.value)
        for batch in batches:
            rows = []
            for row, ids in zip(batch.itertuples(), rans.decode(batch["payload"].tolist(), table)):
                at = 0
                for i, (own, length) in enumerate(zip(row.docs, row.lengths)):
                    crc = zlib.crc32(ids[at:at + length].astype("<u4").tobytes())
                    rows.append((row.part, row.block + i, row.piece, row.whole, own, row.offset + at, length, crc))
                    at += length
            names = ["part", "seq", "piece", "whole", "doc_id", "offset", "n", "crc"]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": object})

    def pieces(of: str) -> DataFrame:
        # Chosen by block, so that no block is decoded twice.
        return blocks.where(of).mapInPandas(
            unpack, f"part int, seq long, piece int, whole boolean, doc_id {kind}, offset long, n long, crc long")

    @F.pandas_udf("long")
    def joined_crc(crcs: pd.Series, lengths: pd.Series) -> pd.Series:
        totals = []
        for own, sizes in zip(crcs, lengths):
            total = 0
            for crc, n in zip(own, sizes):
                total = crc_shift(total, 4 * int(n)) ^ int(crc)
            totals.append(total)
        return pd.Series(totals, dtype="int64")

    # Documents of several blocks: their pieces' checksums are combined, their ids stay where they are.
    cut = pieces("not whole").groupBy("part", "seq").agg(
        F.first("doc_id").alias("doc_id"), F.min("offset").alias("offset"), F.sum("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("piece", "crc", "n"))).alias("p"),
    )
    cut = cut.select("part", "doc_id", "offset", "n", joined_crc("p.crc", "p.n").alias("crc"))
    whole = pieces("whole").select("part", "doc_id", "offset", "n", "crc")
    sizes = blocks.groupBy("part").agg(F.sum("size").alias("size"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    # One row per part, that is per task of the writer.
    found = whole.unionByName(cut).join(F.broadcast(starts), "part")
    return found.select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), F.col("n").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"),
    )
