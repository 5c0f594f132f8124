"""Secret scans: keyword prefilter, anchored expressions near the hits, embedded checksums.

One pass of an Aho-Corasick automaton over the lower-cased text reports where a keyword ends.
Only there is the expression of its kind matched, anchored at the keyword, so that the text is
never searched by every expression. Kinds with a checksum inside the secret are validated last.
Runs of hex digits have no keyword; they come from one scan for long runs.

Defined results: a null text has no spans; positions are code points, ends exclusive. Rows are
independent, so repeated rows and tied ids give repeated results, and an empty table gives none.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from nearkin.llm.common import chunks, free_name, texts_of, with_columns

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "jwt", "pem")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")
# the body may have header lines, as keys with a passphrase do
PEM = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY(?: BLOCK)?)-----(?:[^-]|-(?!----))++-----END \1-----")
JWT_RUN = re.compile(r"[A-Za-z0-9_-]*")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base62_crc32(body: str) -> str:
    """CRC-32 of ``body`` in six base-62 digits, as token issuers append it."""
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0")


def _has_crc(match: re.Match) -> bool:
    return base62_crc32(match[1]) == match[2]


def _is_jwt(match: re.Match) -> bool:
    try:
        header = json.loads(base64.urlsafe_b64decode(match[1] + "=" * (-len(match[1]) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return isinstance(header, dict) and "alg" in header


# kind -> keywords in lower case, expression anchored at the keyword, check of a match
RULES: dict[str, tuple[tuple[str, ...], re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"), ASSIGN,
               lambda m: len(m[1]) >= ASSIGN_LEAST),
    "access": (("akia",), ACCESS, lambda m: len(m[0]) >= ACCESS_LEAST),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), GITHUB, _has_crc),
    "npm": (("npm_",), NPM, _has_crc),
    "jwt": (("eyj",), JWT, _is_jwt),
    "pem": (("-----begin ",), PEM, lambda m: True),
}


def automaton() -> ahocorasick.Automaton:
    """Reports (kind, length) at the end of each keyword."""
    found = ahocorasick.Automaton()
    for kind, (words, _, _) in RULES.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def spans_of(text: str, words: ahocorasick.Automaton) -> list[Span]:
    """All spans of a text by start, then kind.

    Per kind the leftmost matches that do not overlap count, the way a search goes: a match
    whose check fails is dropped, yet the search goes on behind it.
    """
    spans: list[Span] = [(m.start(), KINDS.index("hex"), m.end()) for m in HEX.finditer(text)]
    # bytes.lower changes A-Z alone, so positions stay those of the text
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    hits = sorted((end - length + 1, kind) for end, (kind, length) in words.iter(lowered))
    after = dict.fromkeys(RULES, 0)
    for start, kind in hits:
        if start < after[kind]:
            continue
        _, expression, valid = RULES[kind]
        match = expression.match(text, start)
        if match:
            after[kind] = match.end()
            if valid(match):
                spans.append((start, KINDS.index(kind), match.end()))
        elif kind == "jwt":
            # what follows the run decides for all its starts, so none of them scans it again
            after[kind] = JWT_RUN.match(text, start).end()
    return sorted(spans)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[Span], mark: str) -> str:
    """The text with each maximal stretch of overlapping spans replaced by ``mark``."""
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def scan(df: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``df`` with an array of (kind, start, end) for each row's text, in one narrow pass."""
    keep, out = df.columns, free_name(df, spans)
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType())])
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(span))])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in chunks(batches, text):
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(t, words)] for t in texts_of(batch, text)]
            yield with_columns(batch, keep, {out: pa.array(found, arrow)})

    return df.mapInArrow(scanned, schema)


def digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans as text, per row."""
    rows = df.select(doc_id, text)
    schema = T.StructType([
        rows.schema[doc_id], *[T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS],
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in chunks(batches, text):
            found = [spans_of(t, words) for t in texts_of(batch, text)]
            base = [[s for s in spans if s[1] < len(BASE_KINDS)] for spans in found]
            counts = {f"n_{kind}": pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64())
                      for k, kind in enumerate(BASE_KINDS)}
            yield with_columns(batch, [doc_id], counts | {
                "base_sha256": pa.array([hashlib.sha256(written(s).encode()).hexdigest() for s in base]),
                "spans": pa.array([written(s) for s in found], pa.string())})

    return rows.mapInArrow(digested, schema)


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with the secrets of its texts replaced by ``mark``; null and clean texts stay as they are."""
    keep = df.columns

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in chunks(batches, text):
            at = batch.schema.get_field_index(text)
            texts = [t if t is None else redacted(t, spans_of(t, words), mark) for t in batch.column(at).to_pylist()]
            yield batch.select(keep).set_column(at, text, pa.array(texts, batch.schema.field(at).type))

    return df.mapInArrow(cleaned, df.schema)
