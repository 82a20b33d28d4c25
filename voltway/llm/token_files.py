"""Token-id files: flat unsigned integers and 64-bit document offsets.

Documents are dealt out by ranges of their id and sorted, so part k holds no
larger ids than part k + 1. Each task streams its part into three files:

- ``part-K.ids``: token ids, little-endian unsigned 16 or 32 bits, no header;
- ``part-K.offsets``: little-endian signed 64-bit, one more than documents: the
  place in the part's ids where each document starts, then their number;
- ``part-K.docs``: little-endian signed 64-bit document ids.

A task writes under a name of its own attempt and renames at the end, so a task
that runs again replaces whole files. The manifest (one row per part) is a table
beside them; parts' bases are prefix sums over it. Each part is read by a task
of its own, some thousand documents at a time: through a memory map where the
file system is a mounted one, else by ranges of the files.

Parts are as large as the session's shuffle partitions (adaptive execution sizes
them by bytes) unless their number is given.

Defined results: null and empty texts are the end token alone; a null document
id is written as the smallest 64-bit integer, comes first and is null again when
read (that integer itself can't be an id); repeated ids are all written, in the
order of their texts' hashes, and an id or a text that very many rows share is
dealt to several parts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import posixpath
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltway.llm import common
from voltway.llm.encoding import encoder, public_path

MANIFEST = "part long, n_docs long, n_tokens long"
#: Stands for a null document id in the files.
NULL_ID = -(2**63)
DOCS_A_READ = 10_000
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder's URI; a bare path is a local one."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


@contextmanager
def values(system: fs.FileSystem, path: str, kind: np.dtype) -> Iterator[Callable[[int, int], np.ndarray]]:
    """A function (first, last) -> those numbers of a flat file."""
    if isinstance(system, fs.LocalFileSystem):
        mapped = np.memmap(path, kind, "r")
        yield lambda first, last: mapped[first:last]
        return
    with system.open_input_file(path) as f:
        size = kind.itemsize
        yield lambda first, last: np.frombuffer(f.read_at((last - first) * size, first * size), kind)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, wide: bool = False, drops_white: bool = True,
    id_column: str = "doc_id", text_column: str = "text", parts: int | None = None,
) -> DataFrame:
    """Write the files and the manifest into ``folder``; returns the manifest."""
    spark = docs.sparkSession
    dtype = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, own = context.partitionId(), encoder(tokenizer, drops_white)
        system, base = opened(folder)
        system.create_dir(base, recursive=True)
        ends = (".ids", ".offsets", ".docs")
        drafts = [posixpath.join(base, f"_draft-{part:07d}-{context.taskAttemptId()}{e}") for e in ends]
        n_docs = n_tokens = 0
        with system.open_output_stream(drafts[0]) as ids_out, system.open_output_stream(drafts[1]) as offsets_out, system.open_output_stream(drafts[2]) as docs_out:
            for batch in batches:
                found = own.encode(batch.column(1).to_pylist())
                lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
                offsets_out.write((n_tokens + np.cumsum(lengths) - lengths).astype("<i8").tobytes())
                docs_out.write(batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                for ids in found:
                    ids_out.write(np.append(ids, end_id).astype(dtype).tobytes())
                n_docs, n_tokens = n_docs + len(found), n_tokens + int(lengths.sum())
            offsets_out.write(np.array([n_tokens], "<i8").tobytes())
        for draft, e in zip(drafts, ends, strict=True):
            system.move(draft, posixpath.join(base, f"part-{part:07d}{e}"))
        yield pa.RecordBatch.from_pydict({"part": [part], "n_docs": [n_docs], "n_tokens": [n_tokens]})

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    # An id that very many rows share is dealt by its texts' hashes, and a text that very many of them share by the
    # rows' numbers; these only tell equal rows apart, so the files are the same whatever they are.
    hashed = narrow.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    keys = ("doc_id", "hash", "row")
    dealt = hashed.repartitionByRange(parts, *keys) if parts else hashed.repartitionByRange(*keys)
    manifest = dealt.sortWithinPartitions("doc_id", "hash").select("doc_id", "text").mapInArrow(run, MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str, wide: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    dtype = np.dtype("<u4" if wide else "<u2")
    manifest = spark.read.parquet(f"{folder}/manifest").filter("n_docs > 0")
    base = F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")  # one row per part
    bases = manifest.select("part", "n_docs", base.alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = opened(folder)
        for batch in batches:
            for part, n, base in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                path = posixpath.join(at, f"part-{part:07d}")
                with values(system, f"{path}.ids", dtype) as ids, values(system, f"{path}.offsets", np.dtype("<i8")) as offsets, values(system, f"{path}.docs", np.dtype("<i8")) as docs:
                    for first in range(0, n, DOCS_A_READ):
                        last = min(first + DOCS_A_READ, n)
                        cuts, own = np.array(offsets(first, last + 1)), np.array(docs(first, last))
                        crcs = [zlib.crc32(ids(a, b).astype("<u4")) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(own, mask=own == NULL_ID), pa.array(base + cuts[:-1]), pa.array(np.diff(cuts)), pa.array(crcs, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    parts = max(1, manifest.count())
    return bases.repartitionByRange(parts, "part").mapInArrow(run, READ)



def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, parts: int | None = None) -> DataFrame:
    """Write the documents' ids to files in the shared folder and read them back."""
    spark = docs.sparkSession
    folder = common.new_folder(spark, "tokens")
    write_token_files(docs, folder, tokenizer or public_path("word_bpe_49k.json"), end_id, parts=parts)
    return read_token_files(spark, folder)
