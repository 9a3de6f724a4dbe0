"""Secret scans: fixed shapes, and strings that a public vocabulary cannot compress.

A run of token characters is random if a byte-pair vocabulary needs many tokens for it: ordinary words, names
and numbers with structure give three or more characters a token, random ones fewer than two. Runs that are
known digests (hexadecimal of a digest's length, UUIDs) or identifiers (digits only, or parts that are words; letters
of one case are words only if the vocabulary says so) are left out of this test; the fixed shapes are reported whatever
they hold. A run that is not random as a whole is tested between its ``=``, ``/`` and ``_`` too.

Defined results: a null or empty text has no spans; offsets are code points, the end is exclusive; repeated
rows are scanned each; other columns are not read. A document is scanned whole, in one piece.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: the shapes of the base kinds
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
_DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE)
_PARTS = re.compile(r"[/_=+.-]+")
#: Parts of identifiers: words in camel case, a constant or a number; a word may end in a short number.
_PLAIN = re.compile(r"[a-z]*(?:[A-Z][a-z]{2,})*[0-9]{0,4}|[A-Z]+[0-9]{0,4}|[0-9]+")


#: Letters of one case: words only if the vocabulary knows them. Shorter ones tell nothing.
_ONE_CASE = re.compile(r"(?:[a-z]{5,}|[A-Z]{5,})(?=[0-9]{0,4}$)")
_FIELD = re.compile(r"[A-Za-z0-9+-]+")


def _identifier(run: str, vocabulary, most_ratio: float) -> bool:
    parts = [part for part in _PARTS.split(run) if part]
    if not all(_PLAIN.fullmatch(part) for part in parts):
        return False
    letters = [m.group() for part in parts if (m := _ONE_CASE.match(part))]
    return sum(map(len, letters)) >= most_ratio * sum(len(vocabulary.encode_ordinary(x)) for x in letters)


def _random(run: str, vocabulary, most_ratio: float, least: int) -> bool:
    if len(run) < least or _DIGEST.fullmatch(run) or len(run) >= most_ratio * len(vocabulary.encode_ordinary(run)):
        return False
    return not _identifier(run, vocabulary, most_ratio)


def encoding(ranks: bytes, pattern: str):
    """A tiktoken encoding from the content of a ranks file."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def scan(text: str, vocabulary, most_ratio: float, least: int) -> list[tuple[int, int, int]]:
    """Spans of one text as (start, rank of the kind, end), in order."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    for m in _RUN.finditer(text):
        if _random(m.group().rstrip("="), vocabulary, most_ratio, least):
            found.append((m.start(), 3, m.end()))
            continue
        # beside plain words a random field can be lost in the whole
        fields = [f for f in _FIELD.finditer(m.group()) if f.span() != (0, len(m.group()))]
        found += [(m.start() + f.start(), 3, m.start() + f.end()) for f in fields if _random(f.group(), vocabulary, most_ratio, least)]
    return sorted(found)


def _scanner(ranks, pattern: str, most_ratio: float, least: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoding(ranks.value, pattern)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts = batch.column(1)
            spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan(t, vocabulary, most_ratio, least)] if (t := texts[i].as_py()) else [] for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["id", "spans"])

    return rows


def secret_spans(
    spark: SparkSession,
    documents: DataFrame,
    vocabulary: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_ratio: float = 2.0,
    least: int = 20,
) -> DataFrame:
    """Per document row: ``id, spans`` (kind, start, end), by start and then by kind.

    ``vocabulary`` is a tiktoken ranks file the driver can read; its content goes to the tasks as a broadcast of
    about a megabyte, however large the documents are. ``pattern`` is its split rule. A run of ``least`` or more
    characters with fewer than ``most_ratio`` characters a token is random.
    """
    with open(vocabulary, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(source.dtypes)["id"]
    return source.mapInArrow(_scanner(ranks, pattern, most_ratio, least), f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
