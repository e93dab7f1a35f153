"""Secret scan: fixed patterns, and novelty against a primed zstandard dictionary.

Three fixed patterns give the base spans. Beyond them, every long token that follows a sensitive word is a candidate:
its marginal cost is the bytes that zstandard needs for the surrounding text with the candidate less those for
the surrounding text alone, the compressor being primed with a dictionary of identifiers. The surrounding text is taken without
copies of the candidate, so a key that stands twice is found twice. Names, paths and known words cost little; what stays near one byte a
character is random, and is reported as `novel`. The bytes decide for every candidate; the look of one only says how much it must
cost: more without letters and digits mixed, as long names in code have it, and most if it looks like a word (letters
of one case, a first capital aside), as no compressor tells a rare long word from random letters.

Defined cases: a NULL text is empty and has no span; repeated rows give equal results; NULL ids are kept; an empty
table gives no rows; other columns are not read. Texts are scanned whole. Positions are code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import regrouped

#: The base patterns, in the order of their kinds, and the least length of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of [0-9a-f]+ of 24 or more
KINDS = ("assign", "access", "hex", "novel")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
#: Words of which any text with an assign match holds one, in lower case.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Novelty: words that make a context sensitive, how far after one a candidate may start, and its shape.
SENSITIVE = re.compile(r"pass(?:word|wd|phrase|code)|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credential|bearer|authorization|signature|session[ _-]?id", re.IGNORECASE | re.ASCII)
SENSITIVE_WORDS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer", "authorization", "signature", "session")
REACH = 48
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~.-]{16,}")
CONTEXT = 256
#: Marginal bytes for each byte of the candidate from which it counts as random: with the look of a key, of a name, of a word.
NOVELTY, NAME_NOVELTY, WORD_NOVELTY = 0.6, 0.75, 1.1
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
IDENTIFIERS = (
    "password passwd passphrase secret token api_key apikey access_key private_key public_key client_id client_secret credential "
    "authorization bearer signature session_id cookie username user email account config settings environment variable default "
    "example placeholder changeme your-token-here xxxxxxxxxxxxxxxx 0123456789abcdef ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz "
    "https://www.example.com/ http://localhost:8080/ application/json content-type utf-8 base64 sha256 version 1.0.0 2024-01-01T00:00:00Z "
    "function return import export const string number boolean null undefined true false public static void class self this "
    "get set put post delete update create read write open close request response server client database connection host port path "
    "file name value key index length size count type data message error exception warning info debug log test spec main init build "
)
_DICTIONARY = IDENTIFIERS.encode()


class Novelty:
    """Marginal compressed bytes of a candidate next to its surroundings."""

    def __init__(self) -> None:
        primed = zstandard.ZstdCompressionDict(_DICTIONARY, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.packer = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)

    def share(self, around: str, candidate: str) -> float:
        """Marginal bytes for each byte of the candidate."""
        base, own = around.encode("utf-8", "surrogatepass"), candidate.encode()
        return (len(self.packer.compress(base + own)) - len(self.packer.compress(base))) / len(own)


def mixed(token: str) -> bool:
    """Letters and digits, as keys have them: three digits, or one among capitals and small letters."""
    digits = sum(c.isdigit() for c in token)
    inner = any(c.isupper() for c in token[1:]) and any(c.islower() for c in token)
    return sum(c.isalpha() for c in token) >= 3 and (digits >= 3 or (digits >= 1 and inner)) and any(c.isdigit() or c.isupper() for c in token[1 : len(token) // 2])


def least_share(token: str) -> float:
    """How much each byte of a candidate must cost."""
    if _WORD.fullmatch(token):
        return WORD_NOVELTY
    return NOVELTY if mixed(token) else NAME_NOVELTY


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, by start, then kind."""
    found, low = [], text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    """Spans that the novelty test adds; they do not overlap base spans."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE_WORDS):
        return []
    words = [m.end() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    found, word, at = [], 0, 0
    for m in CANDIDATE.finditer(text):
        while word + 1 < len(words) and words[word + 1] <= m.start():
            word += 1
        while at < len(base) and base[at][2] <= m.start():
            at += 1
        # base is sorted by start; a later span may end earlier, so all that start before the candidate's end are looked at.
        if not 0 <= m.start() - words[word] <= REACH or any(s < m.end() and e > m.start() for s, _, e in base[max(0, at - 3) : at + 8]):
            continue
        around = text[max(0, m.start() - CONTEXT) : m.start()] + " " + text[m.end() : m.end() + CONTEXT]
        if novelty.share(around.replace(m[0], ""), m[0]) >= least_share(m[0]):
            found.append((m.start(), 3, m.end()))
    return found


def spans_of(text: str, novelty: Novelty) -> list[tuple[int, int, int]]:
    """All spans of a text, by start, then kind."""
    base = base_spans(text)
    return sorted(base + novel_spans(text, base, novelty))


def redacted(text: str, spans: list[tuple[int, int, int]], mask: str) -> str:
    """The text with every run of overlapping spans replaced by the mask."""
    parts, at, end = [], 0, 0
    for s, _, e in spans:
        if s >= end:
            parts += [text[at:s], mask]
        at = end = max(end, e)
    return "".join(parts) + text[at:]


def scanned(documents: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end; by start, then kind) of every document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in regrouped(batches, "text"):
            spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(t or "", novelty)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    read = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(scan, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def masked(documents: DataFrame, mask: str = "<secret>") -> DataFrame:
    """The documents with their secrets masked; other columns stay, n_chars follows the text."""
    names = documents.columns

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in regrouped(batches, "text"):
            texts = [None if t is None else redacted(t, spans_of(t, novelty), mask) for t in batch.column(names.index("text")).to_pylist()]
            columns = list(batch.columns)
            columns[names.index("text")] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    out = documents.mapInArrow(replace, documents.schema)
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(documents.schema["n_chars"].dataType)) if "n_chars" in names else out


def joined(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_novel, base_sha256, spans."""

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of_kind(k) for k in KINDS]
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
