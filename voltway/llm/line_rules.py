"""Line-first cleaning.

Each line is judged (punctuation, navigation, boilerplate and repetition rules),
failing lines are removed, and a document that thereby loses too large a share
of its words is rejected. Boilerplate is a line with phrases of page furniture,
or one that stands in very many places of the corpus: a first pass counts, for
each line, between how many different pairs of neighbours it stands (lines of
exact and near copies have the same neighbours, so copies don't make a line
boilerplate). Lines between at least ``COMMON_SHARE`` times as many pairs as
there are documents are known to the second pass, which judges each text in one
go; there are at most lines-per-document / COMMON_SHARE of them, whatever the
table's size. Pairs are combined in each task and counted by (line, neighbours)
first, so a very common line isn't a hot key.

Defined results: a null text has no words (all counts 0, rejected as too
short, cleaned text null); an empty text likewise with an empty cleaned text;
equal rows get equal results; other columns of the input pass untouched.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltway.llm.common import in_parts, texts_of

#: Words are separated by these bytes; bytes.split() and bytes.isspace() use the same six.
SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
NOT_COUNTED = CONTINUATION + SPACES

# Separators of menus and breadcrumb lines.
SEPARATORS = ("|", "»", "›", "•", "·")
# Phrases of page furniture, lower case.
BOILERPLATE = (
    "accept all cookies",
    "add to cart",
    "back to top",
    "click here to",
    "cookie policy",
    "enable javascript",
    "follow us on",
    "log in to comment",
    "lorem ipsum",
    "privacy policy",
    "share this article",
    "sign up for our newsletter",
    "skip to content",
    "terms of service",
    "use of cookies",
)

FURNITURE = re.compile("|".join(map(re.escape, BOILERPLATE)))
#: A line is page furniture if it has a phrase, or a menu if it has a separator (three at least), for every so many words or fewer.
WORDS_A_PHRASE, WORDS_A_SEPARATOR = 40, 14

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line is boilerplate if it stands between at least so many different pairs of neighbours for each document, and so many at least.
COMMON_SHARE, COMMON_LEAST = 0.01, 20
MOST_PAIRS = 60_000
#: A document is rejected if more than this share of its words was in removed lines.
MAX_REMOVED = 0.4

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("n_removed_words", T.LongType()),
        T.StructField("removed_by", T.StringType()),
        T.StructField("clean_text", T.StringType()),
    ]
)


def line_fault(line: bytes, words: list[bytes]) -> str | None:
    """The first rule that a line with words fails, or None."""
    n = len(words)
    symbols = len(line) - len(line.translate(None, SYMBOLS))
    if symbols and n >= 4:
        bars = sum(w in (b"|", "»".encode(), "›".encode(), "•".encode(), "·".encode()) for w in words)
        if bars >= 3 and 4 * bars >= n:
            return "navigation"
        if 3 * symbols >= n:
            return "symbols"
    if n >= 4 and (b"!!" in line or b"??" in line or b"..." in line):
        ends = sum(w.endswith((b"!!", b"??", b"...")) for w in words)
        if 2 * ends > n:
            return "punctuation"
    text = line.decode("utf-8", "replace").lower()
    if any(text.count(s) >= 3 for s in SEPARATORS[1:]) and WORDS_A_SEPARATOR * sum(text.count(s) for s in SEPARATORS[1:]) >= n:
        return "navigation"
    phrases = FURNITURE.findall(text)
    if phrases and WORDS_A_PHRASE * len(phrases) >= n:
        return "boilerplate"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a three-word window found at least twice."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, reach = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + 3 - max(reach, at)
            reach = at + 3
    return covered


def line_hash(line: bytes) -> int:
    return xxhash.xxh3_64_intdigest(line.strip()) - (1 << 63)


def neighbours(text: bytes) -> Iterator[tuple[int, int]]:
    """(hash of a line, hash of the lines before and after it) of each line with words."""
    hashes = [0, *(line_hash(x) for x in text.split(b"\n") if x.split()), 0]
    for before, own, after in zip(hashes, hashes[1:], hashes[2:], strict=False):
        yield own, hash((before, after))


def common_lines(docs: DataFrame, text_column: str = "text", share: float = COMMON_SHARE, least: int = COMMON_LEAST) -> frozenset[int]:
    """Hashes of the lines that count as boilerplate for where they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()

        def made() -> pa.RecordBatch:
            lines, places = zip(*found, strict=True)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(lines, pa.int64()), pa.array(places, pa.int64())], names=["line", "place"])

        for batch in batches:
            for text in texts_of(batch.column(0)):
                if text:
                    found.update(neighbours(text))
                    if len(found) > MOST_PAIRS:
                        yield made()
        if found:
            yield made()

    pairs = docs.select(F.col(text_column).alias("text")).mapInArrow(run, "line long, place long").distinct()
    needed = max(least, share * docs.count())
    return frozenset(r["line"] for r in pairs.groupBy("line").agg(F.count("*").alias("n")).filter(F.col("n") >= needed).select("line").collect())


def judge(text: bytes | None, max_removed: float = MAX_REMOVED, common: frozenset[int] = frozenset()) -> tuple:
    """The fields of RESULT for one text; ``common``: hashes of lines that are boilerplate wherever they stand."""
    if text is None:
        return 0, 0, 0, 0, 0, True, False, 0, "", None
    words = text.split()
    n = len(words)
    repeats = repeated_words(words)
    base_failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
    seen: set[bytes] = set()
    stays, by = [], Counter()
    duplicates = removed = 0
    for line in text.split(b"\n"):
        own = line.split()
        if not own:
            stays.append(line)
            continue
        again = line in seen
        duplicates += again
        seen.add(line)
        fault = "repeated" if again and len(own) >= 3 else line_fault(line, own)
        if not fault and common and line_hash(line) in common:
            fault = "boilerplate"
        if fault:
            by[fault] += len(own)
            removed += len(own)
        else:
            stays.append(line)
    return (
        n,
        len(text.translate(None, NOT_COUNTED)),
        len(text) - len(text.translate(None, SYMBOLS)),
        duplicates,
        repeats,
        base_failed,
        not base_failed and removed <= max_removed * n,
        removed,
        ",".join(sorted(by)),
        b"\n".join(stays).decode("utf-8") if removed else text.decode("utf-8"),
    )


def line_rules(text: Column, max_removed: float = MAX_REMOVED, with_text: bool = True, common: frozenset[int] = frozenset()) -> Column:
    """A struct of RESULT's fields for each text; without ``with_text`` its ``clean_text`` is null."""

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array) -> pa.Array:
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64(), pa.string(), pa.string()]
        made = [pa.StructArray.from_arrays([pa.array([], k) for k in kinds], RESULT.names)]
        for (part,) in in_parts(texts):
            rows = [judge(b, max_removed, common) for b in part.cast(pa.large_binary()).to_pylist()]
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, k) for c, k in zip(columns[:-1], kinds, strict=False)]
            arrays.append(pa.array(columns[-1], pa.string()) if with_text else pa.nulls(len(rows), pa.string()))
            made.append(pa.StructArray.from_arrays(arrays, RESULT.names))
        return pa.concat_arrays(made)

    return run.asNondeterministic()(text)


def judged(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id and all measures and the verdict."""
    rules = line_rules(F.col(text_column), with_text=False, common=common_lines(docs, text_column))
    found = docs.select(F.col(id_column), rules.alias("_rules"))
    return found.select(id_column, *[F.col(f"_rules.{n}").alias(n) for n in RESULT.names if n != "clean_text"])


def cleaned(docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """The kept documents with failing lines removed; all columns as they were, ``length_column`` renewed."""
    names = docs.columns
    kept = docs.withColumn("_voltway_rules", line_rules(F.col(text_column), common=common_lines(docs, text_column))).filter("_voltway_rules.kept")
    text = F.col("_voltway_rules.clean_text")
    put = {text_column: text}
    if length_column in names:
        put[length_column] = F.length(text).cast(docs.schema[length_column].dataType)
    return kept.select(*[put[n].alias(n) if n in put else F.col(n) for n in names])
